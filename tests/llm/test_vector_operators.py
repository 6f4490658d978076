"""Operators on vectors against brute force, and odd tables."""

import collections

import numpy as np
import pytest

from millrace.llm import hamming, neighbours

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, node STRING, rep INT, ids STRING, n INT"
MORE = ("a", 1, "b", 2)


@pytest.fixture(scope="module")
def vectors(spark):
    """Random vectors, close ones, a hot group, equal and scaled ones."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 48))
    x[300:500] = x[:200] + rng.normal(0, 0.1, (200, 48))
    x[600:800] = x[5] + rng.normal(0, 0.1, (200, 48))
    x[800:850] = x[7]
    x[850] = 2 * x[9]
    x = x.astype(np.float32)
    rows = [(i, v.tolist(), int(i % 300 % 3), *MORE) for i, v in enumerate(x)]
    return x.astype(float), spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0, 0.5], 1, *MORE),
        (2, [1.0, 2.0, 0.5], 1, *MORE),
        (2, [1.0, 2.0, 0.5], 1, *MORE),
        (50, [2.0, 4.0, 1.0], 1, *MORE),
        (51, [2.0, 4.0, 1.0], 2, *MORE),
        (52, [2.0, 4.0, 1.0], None, *MORE),
        (53, None, 1, *MORE),
        (54, [0.0, 0.0, 0.0], 1, *MORE),
        (55, [1.0, None, 0.5], 1, *MORE),
        (56, [1.0, nan, 0.5], 1, *MORE),
        (57, [inf, 2.0, 0.5], 1, *MORE),
        (58, [1.0, 2.0], 1, *MORE),
        (59, [], 1, None, None, None, None),
        (None, [1.0, 2.0, 0.5], 1, *MORE),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_links_equal_brute_force(vectors):
    x, frame = vectors
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = np.arange(len(x)) % 300 % 3
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    rows = {r.vec_id: r for r in hamming.near_vectors(frame).collect()}
    found = np.array([rows[i].n_links for i in range(len(x))])
    assert len(rows) == len(x) and (found <= near.sum(axis=1)).all()
    assert found.sum() >= 0.97 * near.sum()
    name = np.arange(len(x))
    for _ in range(40):
        name = np.minimum(name, np.where(near, name[None, :], len(x)).min(axis=1))
    parts = np.array([rows[i].component_id for i in range(len(x))])
    assert (parts == name).mean() >= 0.99 and (parts[found > 0] <= np.arange(len(x))[found > 0]).all()
    assert all(r.kept == (r.component_id == r.vec_id) for r in rows.values())


def test_a_cut_bucket_gives_the_same_links(vectors, monkeypatch):
    _, frame = vectors
    whole = {tuple(r) for r in hamming.near_vectors(frame).collect()}
    monkeypatch.setattr(hamming, "BUCKET", 16)
    assert {tuple(r) for r in hamming.near_vectors(frame).collect()} == whole


def test_links_of_odd_tables(odd_vectors):
    rows = hamming.near_vectors(odd_vectors).collect()
    assert len(rows) == odd_vectors.count()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.vec_id].append((r.n_links, r.component_id, r.kept))
    assert by[1] == [(3, 1, True)] and by[2] == [(3, 1, False)] * 2 and by[50] == [(3, 1, False)]
    for alone in (51, 52, 53, 54, 55, 56, 57, 58, 59):
        assert by[alone] == [(0, alone, True)]
    assert by[None] == [(0, None, True)]
    assert hamming.near_vectors(odd_vectors.where("vec_id > 1000")).count() == 0


def nearest_by_brute_force(x, every=50, k=5):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in range(0, len(x), every):
        score = unit @ unit[q]
        order = sorted((-score[i].round(12), i) for i in range(len(x)) if i != q)[:k]
        out[q] = [i for _, i in order]
    return out


def test_nearest_against_brute_force(vectors):
    x, frame = vectors
    rows = neighbours.nearest(frame).collect()
    found = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(found[r.query_id]) + 1
        found[r.query_id].append(r.vec_id)
        exact = x[r.query_id] @ x[r.vec_id] / np.linalg.norm(x[r.query_id]) / np.linalg.norm(x[r.vec_id])
        assert abs(r.score - exact) < 1e-12
    wanted = nearest_by_brute_force(x)
    assert found.keys() == wanted.keys() and all(len(v) == 5 for v in found.values())
    hits = sum(len(set(found[q]) & set(wanted[q])) for q in wanted)
    assert hits >= 0.95 * 5 * len(wanted)


def test_nearest_of_odd_tables(odd_vectors):
    rows = [(r.query_id, r.rank, r.vec_id) for r in neighbours.nearest(odd_vectors).collect()]
    assert sorted(rows) == [(50, 1, 1), (50, 2, 2), (50, 3, 51), (50, 4, 52)]
    assert neighbours.nearest(odd_vectors.where("vec_id > 1000")).count() == 0


def test_every_query_is_answered(spark):
    """Outliers that stand alone under every rotation, and a table of one vector."""
    rng = np.random.default_rng(4)
    x = rng.normal(0, 0.05, (900, 16)) + np.eye(16)[0]
    for i in range(6):
        x[50 * i] = -np.eye(16)[2 * i + 1] + 0.1 * np.eye(16)[2 * i + 2]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    found = collections.Counter(r.query_id for r in neighbours.nearest(frame).collect())
    assert found == dict.fromkeys(range(0, 900, 50), 5)
    equal = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(60)], frame.schema)
    rows = neighbours.nearest(equal).collect()
    assert {(r.query_id, r.rank, r.vec_id) for r in rows} == {
        *((0, i, i) for i in range(1, 6)), *((50, i + 1, i) for i in range(5))
    }


def test_nearest_inside_a_large_group_of_near_copies(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=64) / 8 + rng.normal(0, 0.0045 / 8, (1500, 64))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    found = collections.defaultdict(set)
    for r in neighbours.nearest(frame).collect():
        found[r.query_id].add(r.vec_id)
    wanted = nearest_by_brute_force(x)
    recall = sum(len(found[q] & set(wanted[q])) for q in wanted) / (5 * len(wanted))
    print(f"recall {recall}")
    assert recall >= 0.95
