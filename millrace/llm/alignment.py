"""Cross-tokenizer alignment: where the tokens of two tokenizers end together, by diagonal run skipping.

Both tokenizers spell the same bytes, so a text's tokens are two rising lists of byte ends. As long as
tokens pair off one to one, the lists agree at a constant index shift; such a stretch is jumped by
slices that double while they agree and are halved where they do not. Where the lists part, a short
merge finds the next common end, which closes an irregular group and sets the shift anew.

What a pair of ids counts in the corpus is asked per batch of documents: a batch lists its distinct
pairs once, with how often it links them; the counts are summed per pair by a shuffle and go back to
the batches, whose documents refer to pairs by their place in the batch's list.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.columns import free
from millrace.llm.tokens import byte_letters, public_path, unusual
from millrace.scratch import cut_lineage

ROWS = 128
B_SHIFT = 20  # a pair of ids is B's, shifted, plus A's
#: The byte-level tokenizer's own pattern.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RESULTS = {"n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "n_best": "long",
           "count_sum": "long", "groups_sha256": "string", "groups": "string"}
_KINDS = {"long": pa.int64(), "string": pa.string()}


def cuts(ends_a: list[int], ends_b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The places in both lists, strictly rising and with one last value, that hold equal values."""
    n, m = len(ends_a), len(ends_b)
    runs_a, runs_b, lengths = [], [], []
    i = j = 0
    while i < n and j < m:
        first_a, first_b = i, j
        step = 1
        while i < n and ends_a[i : i + step] == ends_b[j : j + step]:
            i, j, step = i + step, j + step, 2 * step
        while step > 1:
            step //= 2
            if i < n and ends_a[i : i + step] == ends_b[j : j + step]:
                i, j = i + step, j + step
        i, j = min(i, n), min(j, m)
        if i == first_a:  # tokens that do not pair off: up to the next common end
            a, b = ends_a[i], ends_b[j]
            while a != b:
                if a < b:
                    i += 1
                    a = ends_a[i]
                else:
                    j += 1
                    b = ends_b[j]
            first_a, first_b = i, j
            i, j = i + 1, j + 1
        runs_a.append(first_a)
        runs_b.append(first_b)
        lengths.append(i - first_a)
    length = np.array(lengths, dtype=np.int64)
    within = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    return (np.repeat(np.array(runs_a, np.int64), length) + within,
            np.repeat(np.array(runs_b, np.int64), length) + within)


class Tokenizers:
    """Tokenizer A (byte-level BPE) and tokenizer B (pieces with byte fallback), without special tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path_a)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        with open(path_a, encoding="utf-8") as file:
            model = json.load(file)["model"]
        raw = {c: b for b, c in enumerate(byte_letters())}
        vocab, specials = model["vocab"], self.library.get_added_tokens_decoder()
        self.a = [b""] * (1 + max([*vocab.values(), *specials]))
        for i, token in specials.items():
            self.a[i] = token.content.encode()
        for token, i in vocab.items():
            if i not in specials:
                self.a[i] = bytes(raw[c] for c in token)
        # Ids in the order of merges serve the faster library as ranks.
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merged = [vocab[one + other] for one, other in pairs]
        ranks = {self.a[i]: i for t, i in vocab.items() if i not in specials}
        ordered = merged == sorted(set(merged)) and len(merged) + 256 == len(ranks)
        self.fast = ordered and tiktoken.Encoding("A", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.b = []
        for i in range(self.pieces.get_piece_size()):
            piece = self.pieces.id_to_piece(i)
            whole = piece.replace("▁", " ").encode()
            self.b.append(bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else whole)
        self.size_a = np.array([len(t) for t in self.a])
        self.size_b = np.array([len(t) for t in self.b])
        n, m = [str(i) for i in range(len(self.a))], [str(i) for i in range(len(self.b))]
        #: Ids as written, before a further token of the same side, and at the end of a side of a group.
        self.written = [*(f"{i}," for i in n), *(f"{i}|" for i in n), *(f"{i}," for i in m), *(f"{i};" for i in m)]

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        out = [self.fast.encode_ordinary(t) if self.fast and not unusual(t) else None for t in texts]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, found in zip(rest, self.library.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = found.ids
        return out

    def encode(self, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        """Both sides' ids; none where the sides do not spell a space and the text."""
        given = [t or "" for t in texts]
        side_a = self.encode_a([" " + t for t in given])
        side_b = self.pieces.encode(given, num_threads=1)
        for i, text in enumerate(given):
            told = b" " + text.encode()
            same = text and b"".join(map(self.a.__getitem__, side_a[i])) == told
            if not same or b"".join(map(self.b.__getitem__, side_b[i])) != told:
                side_a[i], side_b[i] = [], []
        return side_a, side_b


@functools.cache
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


class Aligned:
    """The alignment of a list of texts. ``first_*``: tokens or groups before each text, and of all."""

    def __init__(self, tool: Tokenizers, texts: list[str | None]):
        side_a, side_b = tool.encode(texts)
        self.tool = tool
        self.ids_a = np.concatenate([np.array(x, np.int64) for x in [[], *side_a]])
        self.ids_b = np.concatenate([np.array(x, np.int64) for x in [[], *side_b]])
        self.first_a = np.cumsum([0, *map(len, side_a)])
        self.first_b = np.cumsum([0, *map(len, side_b)])
        ends_a, ends_b = np.cumsum(tool.size_a[self.ids_a]), np.cumsum(tool.size_b[self.ids_b])
        self.cut_a, self.cut_b = cuts(ends_a.tolist(), ends_b.tolist())
        self.first_group = np.searchsorted(self.cut_a, self.first_a)

    def pairs(self) -> np.ndarray:
        """The linked ids of each group: its last tokens."""
        return (self.ids_b[self.cut_b] << B_SHIFT) + self.ids_a[self.cut_a]

    def groups(self) -> list[str]:
        """Each text's groups: ids by commas, sides by a bar, groups by semicolons."""
        n, m = len(self.tool.a), len(self.tool.b)
        last_a, last_b = np.zeros(len(self.ids_a), np.int64), np.zeros(len(self.ids_b), np.int64)
        last_a[self.cut_a], last_b[self.cut_b] = n, m
        group_a = np.searchsorted(self.cut_a, np.arange(len(last_a)))
        group_b = np.searchsorted(self.cut_b, np.arange(len(last_b)))
        shown = np.empty(len(last_a) + len(last_b), dtype=np.int64)
        before_b = np.concatenate(([0], self.cut_b + 1))
        shown[np.arange(len(last_a)) + before_b[group_a]] = self.ids_a + last_a
        shown[np.arange(len(last_b)) + (self.cut_a + 1)[group_b]] = self.ids_b + last_b + 2 * n
        words = [*map(self.tool.written.__getitem__, shown.tolist())]
        edges = (self.first_a + self.first_b).tolist()
        return ["".join(words[a:b])[:-1] for a, b in zip(edges[:-1], edges[1:], strict=True)]


def aligned(
    docs: DataFrame,
    results: tuple[str, ...] = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"),
    path_a: str | None = None,
    path_b: str | None = None,
    text: str = "text",
    carry: tuple[str, ...] | None = None,
) -> DataFrame:
    """Per row: the columns of ``carry`` (by default all), then ``results`` out of ``RESULTS``.

    Tokenizer A reads a space and the text, tokenizer B the text, to which it adds the space. ``n_a``,
    ``n_b``: tokens; ``n_groups``: stretches between common ends; ``n_links``: pairs of tokens that end
    together; ``count_sum``: over links, how many links of all rows have the same two ids; ``n_best``:
    links whose count is the highest of their B id, ties included; ``groups``: ids as
    ``a1,a2|b1;a3|b2,b3``, and its hash ('' without tokens).

    A text that is null, empty, or that a side does not spell byte for byte has no tokens: zeros.
    Repeated rows and null ids count and come out like others; an input column named like a result is
    left out; an empty table gives an empty one. Tokens are aligned once and stored in the shared
    folder. A batch of texts and its tokens must fit a task, some 60 times the texts' bytes.
    """
    path_a = path_a or public_path("byte_bpe_50k.json")
    path_b = path_b or public_path("piece_bpe_32k.model")
    own = [f for f in docs.schema if f.name in (docs.columns if carry is None else carry)]
    own = [f for f in own if f.name not in results]
    names = [f.name for f in own]
    batch_id, links, pairs, times = (free(c, [*names, *results]) for c in ("batch", "links", "pairs", "times"))
    told = [c for c in results if c not in ("n_best", "count_sum")]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in own])  # null in a batch's own row
    for c in told:
        schema = schema.add(c, RESULTS[c])
    stored = T.StructType(list(schema)).add(batch_id, "long").add(links, "binary")
    stored = stored.add(pairs, T.ArrayType(T.LongType())).add(times, T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = tokenizers(path_a, path_b)
        task = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(batches):
            facts: dict[str, list] = {c: [] for c in told}
            found, sizes = [np.zeros(0, np.int64)], []
            for at in range(0, batch.num_rows, ROWS):
                part = Aligned(tool, batch.column(0).slice(at, ROWS).to_pylist())
                groups = part.groups() if {"groups", "groups_sha256"} & set(told) else []
                here = {
                    "n_a": np.diff(part.first_a), "n_b": np.diff(part.first_b),
                    "n_groups": np.diff(part.first_group), "n_links": np.diff(part.first_group),
                    "groups": groups, "groups_sha256": [g and hashlib.sha256(g.encode()).hexdigest() for g in groups],
                }
                for c in told:
                    facts[c].extend(here[c])
                found.append(part.pairs())
                sizes.extend(np.diff(part.first_group))
            distinct, place, n = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
            packed = [_press(p) for p in np.split(place.astype("<u4"), np.cumsum(sizes)[:-1])] if sizes else []
            rows = batch.num_rows
            none = pa.nulls(rows, pa.list_(pa.int64()))
            columns = [*batch.columns[1:], *(pa.array(facts[c], _KINDS[RESULTS[c]]) for c in told)]
            columns += [pa.array([task + number] * rows, pa.int64()), pa.array(packed, pa.binary()), none, none]
            out = pa.record_batch(columns, names=stored.names)
            yield out
            lists = [pa.array([x], pa.list_(pa.int64())) for x in (distinct, n)]
            blank = [pa.nulls(1, f.type) for f in out.schema][: len(own) + len(told)]
            ends = [pa.array([task + number], pa.int64()), pa.nulls(1, pa.binary()), *lists]
            yield pa.record_batch([*blank, *ends], schema=out.schema)

    picked = docs.select(F.col(text).alias(free("aligned", names)), *[F.col(f"`{c}`") for c in names])
    table = picked.mapInArrow(run, stored)
    if len(told) == len(results):
        return table.where(F.col(pairs).isNull()).select(*[F.col(f"`{c}`") for c in (*names, *results)])
    table = cut_lineage(table, "aligned")
    return _counted(table, names, results, (batch_id, links, pairs, times), schema)


def _press(values: np.ndarray) -> bytes:
    return len(values).to_bytes(4, "little") + pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def _open(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    raw = pa.decompress(data[4:], decompressed_size=4 * n, codec="zstd", asbytes=True)
    return np.frombuffer(raw, "<u4")


def _counted(table: DataFrame, names: list[str], results: tuple[str, ...], parts: tuple[str, ...], schema: T.StructType) -> DataFrame:
    """The stored rows with the results that take all rows' counts."""
    batch_id, links, pairs, times = parts
    listed = table.where(F.col(pairs).isNotNull()).select(
        F.col(batch_id).alias("batch"),
        F.posexplode(F.arrays_zip(F.col(pairs).alias("pair"), F.col(times).alias("n"))).alias("at", "one"),
    )
    listed = listed.select("batch", "at", "one.pair", "one.n")
    counts = listed.groupBy("pair").agg(F.sum("n").alias("n"))
    of_b = Window.partitionBy(F.shiftright("pair", B_SHIFT))
    counts = counts.withColumn("best", F.col("n") == F.max("n").over(of_b))
    counts = cut_lineage(counts, "pair-counts")
    answers = listed.drop("n").join(counts, "pair").select("batch", "at", "n", "best")
    for c in ("n_best", "count_sum"):
        if c in results:
            schema = schema.add(c, "long")
    schema = T.StructType([*(schema[c] for c in names), *(schema[c] for c in results)])

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        at = right["at"].to_numpy()
        n, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        n[at], best[at] = right["n"].to_numpy(), right["best"].to_numpy(zero_copy_only=False)
        places = [_open(p.as_py()) for p in left[links]]
        more = {
            "count_sum": pa.array([int(n[p].sum()) for p in places], pa.int64()),
            "n_best": pa.array([int(best[p].sum()) for p in places], pa.int64()),
        }
        columns = [left[c] if c in left.column_names else more[c] for c in schema.names]
        return pa.table(columns, names=schema.names)

    rows = table.where(F.col(pairs).isNull()).drop(pairs, times)
    return rows.groupBy(batch_id).cogroup(answers.groupBy("batch")).applyInArrow(summed, schema)
