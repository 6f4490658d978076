"""The block exchange, word places and hashes, and components."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
from conftest import prose
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import blocks
from millrace.llm.components import components
from millrace.llm.words import Words


@given(st.lists(st.integers(-(2**63), 2**63 - 1), max_size=300))
@settings(deadline=None)
def test_packed_values_return(values):
    array = np.array(values, dtype=np.int64)
    if len(array):
        assert (blocks.unpack(blocks.pack(array), len(array)) == array).all()


@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t\x0b\x1cé漢", max_size=40)), max_size=12))
@settings(max_examples=200, deadline=None)
def test_words_are_where_the_pattern_finds_them(texts):
    words = Words(pa.array(texts, pa.string()))
    data = words.data.tobytes()
    found = [data[a:b].decode() for a, b in zip(words.start, words.end, strict=True)]
    wanted = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert found == [w for ws in wanted for w in ws]
    assert np.diff(words.first).tolist() == [len(w) for w in wanted]
    hashes = dict(zip(found, words.hashes().tolist(), strict=True))
    assert len(set(hashes.values())) == len(hashes)
    assert all(hashes[w] == h for w, h in zip(found, words.hashes().tolist(), strict=True))


def test_hashes_do_not_depend_on_the_batch():
    texts = ["one two three", "x" * 700_000 + " two", prose(1, 50_000, 10**9)]
    alone = [Words(pa.array([t])).hashes() for t in texts]
    assert (Words(pa.array(texts)).hashes() == np.concatenate(alone)).all()
    where, runs = Words(pa.array(texts)).runs(3)
    assert len(where) == 1 + 0 + 49_998 and len(set(runs.tolist())) == len(runs)


def test_every_key_is_answered_with_the_sum_over_all_blocks(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 400)
    texts = [prose(i, 30, 60) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    total = blocks.text_bytes(docs)
    dealt = blocks.dealt(docs, total, "doc_id", "text")

    def count(table):
        return np.unique(Words(table["text"]).hashes(), return_counts=True)

    def told(left, right):
        keys = np.unique(Words(left["text"]).hashes()).view(np.int64)
        return pa.table({"key": keys, "n": blocks.answers_of(right)})

    answers = blocks.ask(dealt, total, count, blocks.sum_by_key)
    rows = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(told, "key long, n long").collect()
    assert dealt.select("block").distinct().count() > 10
    wanted = collections.Counter(w for t in texts for w in t.split())
    by_hash = dict(zip(Words(pa.array([" ".join(wanted)])).hashes().view(np.int64).tolist(), wanted, strict=True))
    assert {by_hash[r.key] for r in rows} == set(wanted)
    assert all(r.n == wanted[by_hash[r.key]] for r in rows)


def counted_through_levels(spark, n_texts):
    """Pieces of each level, and each word's count as the blocks are told it."""
    texts = [prose(i, 30, 60) for i in range(n_texts)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    total = blocks.text_bytes(docs)
    dealt = blocks.dealt(docs, total, "doc_id", "text")

    def count(table):
        return np.unique(Words(table["text"]).hashes(), return_counts=True)

    def told(left, right):
        keys = np.unique(Words(left["text"]).hashes()).view(np.int64)
        return pa.table({"key": keys, "n": blocks.answers_of(right)})

    levels = blocks.pieces_of(dealt, total, count)
    answers = blocks.answered(levels, total, blocks.sum_by_key)
    rows = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(told, "key long, n long").collect()
    wanted = collections.Counter(w for t in texts for w in t.split())
    hashed = Words(pa.array([" ".join(wanted)])).hashes().view(np.int64).tolist()
    assert {(r.key, r.n) for r in rows} == set(zip(hashed, wanted.values(), strict=True))
    return [level.count() for level in levels]


def test_pieces_of_a_level_grow_as_the_bytes(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 1_000)
    monkeypatch.setattr(blocks, "BUCKET_KEYS", 60)
    monkeypatch.setattr(blocks, "FAN", 4)
    small, large = counted_through_levels(spark, 60), counted_through_levels(spark, 240)
    assert len(large) > len(small) > 1
    assert max(large) <= 4.4 * max(small)


def test_ranges_of_levels_are_nested(monkeypatch):
    for total in (0, 10**9, 10**10, 10**12, 10**14):
        found = blocks.ranges(total)
        assert found[-1] >= total // 5 // blocks.BUCKET_KEYS
        assert all(b % a == 0 and b // a <= blocks.FAN for a, b in zip([1, *found[:-1]], found, strict=True))


def test_components_equal_union_find(spark):
    draw = random.Random(2)
    links = [(i, i + 1) for i in range(100, 140)] + [(7, n) for n in range(200, 260)]
    links += [(draw.randrange(300, 500), draw.randrange(300, 500)) for _ in range(90)] + [(1, 1)]
    name = {n: n for link in links for n in link}

    def find(n):
        while name[n] != n:
            n = name[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        name[max(a, b)] = min(a, b)
    frame = spark.createDataFrame(links, "a BIGINT, b BIGINT")
    found = {r.node: r.component for r in components(frame).collect()}
    assert found == {n: find(n) for n in found}
    assert set(found) == {n for a, b in links if a != b for n in (a, b)}
    assert components(frame.where("a < 0")).count() == 0
