"""Substring dedup by relative Lempel-Ziv parsing of documents against indexed blocks.

The documents are the reference of one another, cut into blocks of a few megabytes. A block's index
holds each distinct run of ``window`` words at its first place: the smallest document with it, and the
word of that document it starts at. Every document is parsed against the indexes of all blocks at once.
A factor starts at a word whose run stands in an earlier document (one with a smaller id), and grows
greedily, word by word, as long as the next run's first place is the next word of the same source: so
a factor is a copy of that many words of its source. Runs that lie across the end of a factor are
looked up like all others; where one is found the next factor starts there, within the last words of
the one before, so a copy put together from several sources is covered without gaps. The words that
factors cover are removed: exactly those in runs that an earlier document has.

Most runs stand in one block only. So blocks first ask, by short hashes, which of their runs another
block may have; only those enter the exchanged indexes with their whole hash and place.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import blocks as B
from millrace.llm.words import Words
from millrace.llm.workers import give_back

WINDOW = 13
NONE = np.iinfo(np.int64).max
FACTOR = ("start", "length", "source", "source_start")
FACTORS = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in FACTOR]))
RESULTS = {"n_words": "long", "n_removed": "long", "kept_text": "string", "kept_sha256": "string", "factors": FACTORS}
_FACTOR = pa.list_(pa.struct([(name, pa.int64()) for name in FACTOR]))


def _ids(table: pa.Table, id_col: str) -> np.ndarray:
    return table[id_col].cast(pa.int64()).fill_null(NONE).to_numpy()


def _runs(table: pa.Table, id_col: str, text: str, window: int):
    """The words, where runs start, their hashes, and each run's place: its document's id, its first word there."""
    words = Words(table[text])
    where, hashes = words.runs(window)
    of = words.text_of[where]
    return words, where, hashes, np.stack((_ids(table, id_col)[of], where - words.first[of]))


def _first_places(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, sorted, the first place of each, and the number of each row's key among them."""
    order = np.argsort(keys)
    found = keys[order]
    heads = B.group_heads(found)
    size = np.diff(np.append(heads, len(keys)))
    several = np.repeat(size > 1, size)  # only these need an order among themselves
    rows = order[several]
    order[several] = rows[np.lexsort((rows, places[0, rows], keys[rows]))]  # words of one text stay in order
    number = np.empty(len(keys), np.int64)
    number[order] = np.repeat(np.arange(len(heads)), size)
    return found[heads], places[:, order[heads]], number


def _least(keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For each row the first place of its key, if that is in a smaller document than the row's own."""
    if not len(keys):
        return places
    docs, at = places
    heads = B.group_heads(keys)
    least = B.spread(np.minimum.reduceat(docs, heads), heads, len(keys))
    start = np.minimum.reduceat(np.where(docs == least, at, NONE), heads)
    return np.where(least < docs, (least, B.spread(start, heads, len(keys))), NONE)


def _short_bits(total: int) -> int:
    """Bits of a short hash: of the runs in this many bytes, under one in a thousand meets another by chance."""
    return min(64, max(32, total.bit_length() + 10))


def _asked(keys: np.ndarray, drop: np.uint64, answers: np.ndarray) -> np.ndarray:
    """Which of a block's sorted keys another block may have, by the answers for its distinct short hashes."""
    return B.spread(answers > 1, B.group_heads(keys >> drop), len(keys))


def _kept(words: Words, removed: np.ndarray) -> list[bytes]:
    """Each text's words that stay, joined by one space."""
    gap = np.zeros(len(words.data) + 1, dtype=np.int8)
    gap[words.start[~removed]] = 1
    stop = words.end[~removed]
    gap[stop + 1] -= 1  # the white space after a kept word stays as its separator
    mask = np.cumsum(gap[:-1], dtype=np.int8).view(bool)
    data = words.data.copy()
    data[stop] = 32
    out, data = data[mask].tobytes(), None
    sizes = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))[words.offset]
    return [out[a : max(a, b - 1)] for a, b in zip(sizes[:-1], sizes[1:], strict=True)]


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text: str = "text",
    results: tuple[str, ...] = ("n_words", "n_removed", "kept_text", "factors"),
    carry: tuple[str, ...] | None = None,
) -> DataFrame:
    """Per document: words, removed words, the text that stays, and the factors behind it.

    Columns: those of ``carry`` (by default all of the input), then ``results`` out of ``RESULTS``;
    an input column named like a result, or ``block``, is left out. ``kept_text`` is the text itself
    where nothing was removed, else the words that stay, joined by one space. A factor is (first
    word, words, source document, the source's first word).

    A null text has no words and stays null where nothing was removed. A document with a null id
    comes after all others and is never a source; rows that share an id are no source for one
    another, and a factor's source may be any of them. An empty table gives an empty one. Runs of words are compared by a 64-bit hash.
    Starts one job that sums the texts' sizes.
    """
    own = [f for f in docs.schema if f.name in (docs.columns if carry is None else carry)]
    own = [f for f in own if f.name not in (*results, "block") or f.name in (id_col, text)]
    needed = list(dict.fromkeys([*(f.name for f in own), id_col, text]))
    total = B.text_bytes(docs, text)
    blocks = B.dealt(docs.select(*[f"`{c}`" for c in needed]), total, id_col, text)

    drop = np.uint64(64 - _short_bits(total))

    def short_runs(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        found = B.distinct(Words(table[text]).runs(window)[1] >> drop)
        return found, np.ones(len(found), dtype=np.int64)

    def index(table: pa.Table, met: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        _, _, hashes, places = _runs(table, id_col, text, window)
        keys, local, _ = _first_places(hashes, places)
        asked = _asked(keys, drop, B.answers_of(met))
        return keys[asked], local[:, asked]

    def parse(left: pa.Table, right: pa.Table) -> pa.Table:
        give_back()
        words, where, hashes, places = _runs(left, id_col, text, window)
        keys, local, number = _first_places(hashes, places)
        least = local.copy()
        asked = _asked(keys, drop, B.answers_of(right.filter(pc.equal(right["step"], 0))))
        other = B.answers_of(right.filter(pc.equal(right["step"], 1)), 2)
        least[:, asked] = np.where(other[0] < local[0, asked], other, local[:, asked])
        source = least[:, number]
        hit = source[0] < places[0]
        start, stop, source = _factors(words, where[hit], source[:, hit], window)
        steps = np.bincount(start, minlength=len(words.start) + 1) - np.bincount(stop, minlength=len(words.start) + 1)
        removed = np.cumsum(steps[:-1]) > 0
        n_words = np.diff(words.first)
        lost = np.concatenate(([0], np.cumsum(removed)))[words.first]
        n_removed = np.diff(lost)
        out = {"n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64())}
        if {"kept_text", "kept_sha256"} & set(results):
            kept = _kept(words, removed)
            if "kept_sha256" in results:
                out["kept_sha256"] = pa.array([hashlib.sha256(k).hexdigest() for k in kept])
            if "kept_text" in results:
                texts = left[text].to_pylist()
                out["kept_text"] = pa.array(
                    [k.decode() if n else t for k, n, t in zip(kept, n_removed, texts, strict=True)], pa.string()
                )
        if "factors" in results:
            out["factors"] = _told(words, start, stop, source)
        columns = [left[f.name] for f in own] + [out[c] for c in results]
        return pa.table(columns, names=[*(f.name for f in own), *results])

    schema = T.StructType(list(own))
    for c in results:
        schema = schema.add(c, RESULTS[c])
    met = B.ask(blocks, total, short_runs, B.sum_by_key, drop_bits=int(drop))
    first = B.ask(blocks, total, index, _least, width=2, beside=met)
    answers = met.withColumn("step", F.lit(0)).unionByName(first.withColumn("step", F.lit(1)))
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(parse, schema)


def _factors(
    words: Words, where: np.ndarray, source: np.ndarray, window: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The factors' first words, the words after their last, and the places in their sources."""
    text = words.text_of[where]
    new = np.ones(len(where), dtype=bool)
    new[1:] = (np.diff(where) != 1) | (np.diff(text) != 0) | (np.diff(source) != [[0], [1]]).any(axis=0)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(where)) - 1
    return where[heads], where[tails[: len(heads)]] + window, source[:, heads]


def _told(words: Words, start: np.ndarray, stop: np.ndarray, source: np.ndarray) -> pa.Array:
    text = words.text_of[start]
    parts = (start - words.first[text], stop - start, *source)
    rows = pa.StructArray.from_arrays([pa.array(p, pa.int64()) for p in parts], fields=list(_FACTOR.value_type))
    counts = np.bincount(text, minlength=len(words.offset) - 1)
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), rows).cast(_FACTOR)
