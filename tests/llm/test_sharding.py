"""Sharding keeps groups whole when nearly every row is linked, and cuts few links of general graphs."""

import collections
import random

import pytest

from millrace.llm import sharding


def placed(spark, sizes):
    texts = [f"group {g}" for g, n in enumerate(sizes) for _ in range(n)]
    random.Random(1).shuffle(texts)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").repartition(6)
    rows = sharding.by_equal_texts(frame).collect()
    load = collections.Counter(r.shard for r in rows)
    assert len(rows) == len(texts) and max(load.values()) - min(load.values()) <= 1
    assert sorted((r.shard, r.slot) for r in rows) == [(s, i) for s in range(16) for i in range(load[s])]
    shards = collections.defaultdict(collections.Counter)
    for r in rows:
        shards[texts[r.doc_id]][r.shard] += 1
    return shards


@pytest.mark.parametrize(("size", "groups"), [(2, 1500), (5, 600)])
def test_groups_stay_whole_when_every_row_is_linked(spark, size, groups):
    shards = placed(spark, [size] * groups)
    assert sum(len(s) == 1 for s in shards.values()) >= 0.95 * groups


def test_an_oversized_group_goes_to_few_shards(spark):
    shards = placed(spark, [700] + [3] * 300)
    most = sum(n for _, n in shards["group 0"].most_common(7))
    assert most >= 0.95 * 700, "a shard holds 100 rows"
    assert sum(len(s) == 1 for t, s in shards.items() if t != "group 0") >= 0.9 * 300


def test_few_links_between_communities_are_cut(spark):
    draw = random.Random(4)
    links = []
    for c in range(64):
        own = range(c * 20, c * 20 + 20)
        links += [(a, draw.choice(own)) for a in own for _ in range(4)]
        links += [(draw.choice(own), draw.randrange(1280)) for _ in range(4)]
    links += links[:50] + [(b, a) for a, b in links[50:90]] + [(3, 3)]
    frame = spark.createDataFrame(links, "a BIGINT, b BIGINT")
    labels = {r.node: r.shard for r in sharding.propagate(frame, 1280, rounds=10).collect()}
    between = {(min(a, b), max(a, b)) for a, b in links if a != b}
    kept = sum(labels[a] == labels[b] for a, b in between) / len(between)
    load = collections.Counter(labels.values())
    assert set(labels) == {x for e in between for x in e}
    assert kept > 0.5, "by chance a sixteenth is kept"
    assert max(load.values()) <= 1.6 * 1280 / 16
    assert sharding.propagate(frame.limit(0), 0).count() == 0
