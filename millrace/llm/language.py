"""Language ID by error-correcting output codes.

Every language has a codeword of bits; for each bit a logistic classifier over hashed byte n-grams
learns whether a text's language has it set. Up to seven languages get the exhaustive code (all ways
to split them in two), more get a random code of ``RANDOM_BITS`` bits, of ``BITS_PER_DOUBLING`` for each
doubling of their number where that is more. A text's language is the
codeword with the least logistic loss summed over the bits, each bit weighted by how well its
classifier did on the part of the sample it did not learn from. A text whose two best codewords lie
close is flagged as ambiguous.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.workers import give_back

SAMPLE = 800  # labelled documents learnt from, per language, about
SAMPLE_OF_ALL = 16_000  # of all languages: with more than twenty, each has an equal part of it
DIMENSIONS = 1 << 15
RANDOM_BITS = 63
BITS_PER_DOUBLING = 12
EPOCHS = 6
AMBIGUOUS = 0.5
UNKNOWN = "und"
HAS_LETTER = re.compile(r"[^\W\d_]")
_MIX = np.uint32(0x9E3779B1)
_SALTS = {n: np.uint32(n * 0x85EBCA77 & 0xFFFFFFFF) for n in (2, 3, 4)}


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's hashed byte 2- to 4-grams: roots of counts, of length one."""
    data = np.frombuffer((" " + text.lower() + " ").encode(), np.uint8).astype(np.uint32)
    found, code = [], data[:-1] << np.uint32(8) | data[1:]
    for n in (2, 3, 4):
        found.append((code * _MIX + _SALTS[n]) >> np.uint32(17))
        if n < 4 and len(data) > n:
            code = code[:-1] << np.uint32(8) | data[n:]
        elif n < 4:
            break
    counts = np.bincount(np.concatenate(found), minlength=DIMENSIONS)
    place = np.flatnonzero(counts)
    value = np.sqrt(counts[place]).astype(np.float32)
    return place, value / np.sqrt((value * value).sum())


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A row of +1 and -1 per language; no column is constant, no two rows are equal."""
    if n <= 7:
        splits = [[1] + [1 if (s >> i) & 1 else -1 for i in range(n - 1)] for s in range(2 ** (n - 1) - 1)]
        return np.array(splits, dtype=np.float32).T.reshape(n, -1)
    rng = np.random.default_rng(seed)
    bits = max(RANDOM_BITS, BITS_PER_DOUBLING * int(n - 1).bit_length())
    while True:
        code = rng.choice(np.array([-1, 1], dtype=np.float32), size=(n, bits))
        if len(np.unique(code, axis=0)) == n and (abs(code.sum(axis=0)) < n).all():
            return code


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weight: np.ndarray  # features x bits
    bias: np.ndarray
    trust: np.ndarray  # per bit

    def margins(self, text: str) -> np.ndarray:
        place, value = features(text)
        return value @ self.weight[place] + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score from 0 to 1, whether it is ambiguous."""
        if not text or not self.languages or not HAS_LETTER.search(text):
            return UNKNOWN, 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        loss = np.logaddexp(0, -self.code * self.margins(text)) @ self.trust
        share = np.exp(loss.min() - loss)
        best = int(loss.argmin())
        score = float(1 / share.sum())
        return self.languages[best], score, score < AMBIGUOUS


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], languages: list[str]) -> Model:
    """Logistic regression by stochastic steps, all bits at once; every fifth row only rates bits."""
    n = len(languages)
    code = codewords(n) if n > 1 else np.ones((n, 0), np.float32)
    bits = code.shape[1]
    weight = np.zeros((DIMENSIONS, bits), dtype=np.float32)
    bias = np.zeros(bits, dtype=np.float32)
    number = {name: i for i, name in enumerate(languages)}
    rate_on = rows[4::5]
    learn = [r for i, r in enumerate(rows) if i % 5 != 4] if len(rows) >= 10 else rows
    rng = np.random.default_rng(11)
    for epoch in range(EPOCHS if bits else 0):
        step = np.float32(8.0 / (1 + epoch))
        for i in rng.permutation(len(learn)):
            name, place, value = learn[i]
            target = code[number[name]]
            margin = value @ weight[place] + bias
            slope = step * target / (1 + np.exp(np.clip(target * margin, -30, 30)))
            weight[place] += value[:, None] * slope
            bias += np.float32(0.02) * slope
    wrong = np.ones(bits)
    for name, place, value in rate_on:
        wrong += (value @ weight[place] + bias) * code[number[name]] <= 0
    error = np.clip(wrong / (len(rate_on) + 2), 1e-3, 0.499)
    return Model(languages, code, weight, bias, np.log((1 - error) / error) / max(1, bits))


def learnt_fold(id_col: str) -> Column:
    """Three quarters of the documents, by their id; a null id is not learnt from."""
    return F.crc32(F.col(id_col).cast("string")) % 4 != 2


def fit(docs: DataFrame, fold: Column, text: str = "text", label: str = "lang", id_col: str = "doc_id") -> Model:
    """Learn every label of the fold from about ``SAMPLE`` rows each, chosen by a hash of the id.

    All languages together have about ``SAMPLE_OF_ALL`` rows; of a rare one all rows are taken, at least
    one of any that has letters. Texts are used whole; what reaches the driver of one is at most
    ``DIMENSIONS`` features, some 8 kB, and a count per label.
    """
    known = docs.where(fold & F.col(label).isNotNull() & F.col(text).isNotNull())
    known = known.select(F.col(id_col).alias("id"), F.col(text).alias("text"), F.col(label).cast("string").alias("label"))
    sizes = known.groupBy("label").count().collect()
    if not sizes:
        return train([], [])
    each = min(SAMPLE, max(1, SAMPLE_OF_ALL // len(sizes)))
    shares = [(row["label"], min(1.0, each / row["count"])) for row in sizes]
    shares = docs.sparkSession.createDataFrame(shares, "label string, share double")
    draw = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1_000_000)) / 1_000_000
    picked = known.join(F.broadcast(shares), "label").where(draw < F.col("share")).select("id", "text", "label")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, name in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if HAS_LETTER.search(text):
                    place, value = features(text)
                    rows.append((name, zlib.crc32(text.encode()), place.astype("<u2").tobytes(), value.tobytes()))
                    middle = len(text) // 2
                    short = text[middle : middle + 40]
                    if HAS_LETTER.search(short):  # short texts are to be told apart too
                        place, value = features(short)
                        rows.append((name, zlib.crc32(short.encode()), place.astype("<u2").tobytes(), value.tobytes()))
            if rows:
                yield pa.record_batch([pa.array(list(c)) for c in zip(*rows, strict=True)], names=["label", "crc", "place", "value"])

    rows = picked.mapInArrow(extract, "label string, crc long, place binary, value binary").collect()
    rows = sorted(rows, key=lambda r: (r["crc"], r["label"], bytes(r["place"])))
    parsed = [(r["label"], np.frombuffer(r["place"], "<u2").astype(np.int64), np.frombuffer(r["value"], np.float32)) for r in rows]
    return train(parsed, sorted({r[0] for r in parsed}))


def predict(
    docs: DataFrame,
    fold: Column | None = None,
    carry: tuple[str, ...] | None = None,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "lang",
) -> DataFrame:
    """Per row: columns ``carry`` (by default all), held_out, lang_pred, score, ambiguous.

    ``fold`` says which rows may be learnt from (by default ``learnt_fold``); held_out is its opposite,
    and false where it is null. Predictions use the text alone. A null text, a text without a letter,
    and every text where nothing could be learnt get ``und`` with score 0. Null labels are not learnt.
    Null and repeated ids pass through; an input column named like a result is left out; an empty
    table gives no rows. Starts two jobs: labels are counted, the sample is drawn.
    """
    fold = learnt_fold(id_col) if fold is None else fold
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, fold, text, label, id_col))
    results = {"held_out": "boolean", "lang_pred": "string", "score": "double", "ambiguous": "boolean"}
    own = [f for f in docs.schema if f.name in (docs.columns if carry is None else carry)]
    own = [f for f in own if f.name not in results]
    held = F.coalesce(~fold, F.lit(False)).alias("held_out")
    picked = docs.select(F.col(text).alias("read"), held, *[F.col(f"`{f.name}`") for f in own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            found = [model.value.predict(t) for t in batch.column(0).to_pylist()]
            columns = list(zip(*found, strict=True)) or [[], [], []]
            kinds = (pa.string(), pa.float64(), pa.bool_())
            told = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.record_batch(
                [*batch.columns[2:], batch.column(1), *told], names=[*(f.name for f in own), *results]
            )

    schema = T.StructType(list(own))
    for name, kind in results.items():
        schema = schema.add(name, kind)
    return picked.mapInArrow(run, schema)
