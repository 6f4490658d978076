"""Secret scans: three fixed patterns, and two character Markov models compared by likelihood ratio.

Both models are of order one, over the characters a credential may hold. The random model learns from
the values that the patterns find in the documents, the ordinary model from all other tokens there;
the labels come from the patterns, and the counts from all documents. A token (a maximal run of such
characters) is a secret when it is long enough, has a digit and a letter, and its log-likelihood ratio
is high enough in total and per character. Pattern spans always stay; a token inside one is not added
again, one that goes beyond it is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.workers import give_back

# The kinds in order, their patterns and least lengths.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(
    r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|"
    r"(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LENGTH = 6

TOKEN = np.zeros(256, dtype=np.int64)
for _i, _c in enumerate(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 1):
    TOKEN[_c] = _i
SYMBOLS = 1 + int(TOKEN.max())  # 0: outside a token
DIGIT = np.zeros(256, dtype=bool)
DIGIT[list(b"0123456789")] = True
LETTER = np.zeros(256, dtype=bool)
LETTER[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True
EVEN = 20.0  # pseudo-counts of the random model per character, spread evenly over the next one
USUAL = 500.0  # of the ordinary model, spread as characters are in general
LENGTH, TOTAL, MEAN = 20, 20.0, 1.1
ROWS = 128
Span = tuple[int, int, int, int, int]  # start, kind, end, secret's start, secret's end


def base_spans(text: str) -> list[Span]:
    """What the patterns find, leftmost and non-overlapping per kind, by start, then kind."""
    found = [
        (m.start(), 0, m.end(), *m.span(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH
    ]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), *m.span()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), *m.span()) for m in HEX.finditer(text)]
    return sorted(found)


def _bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() + b"\n" for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def _steps(data: np.ndarray) -> np.ndarray:
    """The number of each step from a byte to the next, the first one from outside."""
    symbol = TOKEN[data]
    steps = symbol.copy()
    steps[1:] += symbol[:-1] * SYMBOLS
    return steps


def transitions(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts [label, symbol, next symbol] over all documents; label 1: found by a pattern."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, SYMBOLS * SYMBOLS), dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                texts = [t or "" for t in batch.column(0).slice(at, ROWS).to_pylist()]
                spans = [base_spans(t) for t in texts]
                secrets = {t[a:b] for t, found in zip(texts, spans, strict=True) for *_, a, b in found}
                plain = [_without(t, found) for t, found in zip(texts, spans, strict=True)]
                for label, part in enumerate((plain, sorted(secrets))):
                    if part:
                        total[label] += np.bincount(_steps(_bytes(part)[0]), minlength=SYMBOLS**2)
        label, step = np.nonzero(total)
        yield pa.record_batch(
            [pa.array(label, pa.int32()), pa.array(step, pa.int32()), pa.array(total[label, step])],
            names=["label", "step", "n"],
        )

    rows = docs.select(F.col(text)).mapInArrow(count, "label int, step int, n long")
    out = np.zeros((2, SYMBOLS * SYMBOLS))
    for row in rows.groupBy("label", "step").agg(F.sum("n").alias("n")).collect():
        out[row["label"], row["step"]] = row["n"]
    return out.reshape(2, SYMBOLS, SYMBOLS)


def _without(text: str, spans: list[Span]) -> str:
    at, parts = 0, []
    for start, _, end, *_ in spans:
        if start > at:
            parts.append(text[at:start])
        at = max(at, end)
    return " ".join([*parts, text[at:]]) if spans else text


def ratios(counts: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio, random against ordinary, of each step inside a token; 0 elsewhere."""
    ordinary, random = counts[0, :, 1:], counts[1, :, 1:] + EVEN / (SYMBOLS - 1)
    usual = ordinary.sum(axis=0) + 1
    ordinary = ordinary + USUAL * usual / usual.sum()
    out = np.zeros((SYMBOLS, SYMBOLS))
    out[:, 1:] = np.log(random / random.sum(axis=1, keepdims=True))
    out[:, 1:] -= np.log(ordinary / ordinary.sum(axis=1, keepdims=True))
    return out.ravel()


def token_spans(texts: list[str], table: np.ndarray) -> list[list[tuple[int, int]]]:
    """The random tokens of each text, in code points."""
    data, offset = _bytes(texts)
    inside = np.concatenate(([0], (TOKEN[data] > 0).astype(np.int8), [0]))
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = end - start >= LENGTH
    start, end = start[long], end[long]
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    # Bytes and code points run on together, so a text of many tokens is decoded once.
    of, at, points = -1, 0, 0
    for s, e in zip(start, end, strict=True):
        token = data[s:e]
        if not (DIGIT[token].any() and LETTER[token].any()):
            continue
        total = table[_steps(token)].sum()
        if total >= TOTAL and total >= MEAN * (e - s):
            i = int(np.searchsorted(offset, s, side="right")) - 1
            if i != of:
                of, at, points = i, offset[i], 0
            points += int(np.count_nonzero((data[at:s] & 0xC0) != 0x80))
            at, first = s, points
            out[i].append((first, first + int(e - s)))
    return out


def outside(tokens: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The tokens, by start, that no base span, by start, holds whole: one sweep over both."""
    out, reach, i = [], 0, 0
    for start, end in tokens:
        while i < len(base) and base[i][0] <= start:
            reach = max(reach, base[i][2])
            i += 1
        if end > reach:
            out.append((start, end))
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def masked(text: str, spans: list[tuple[int, int, int]], mark: str = "<secret>") -> str:
    """The text with each stretch covered by spans replaced by ``mark``."""
    at, parts = 0, []
    for start, _, end in sorted(spans):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def scan(docs: DataFrame, carry: tuple[str, ...] | None = None, id_col: str = "doc_id", text: str = "text", mask: bool = False) -> DataFrame:
    """Per row: columns ``carry`` (by default all), n_assign, n_access, n_hex, base_sha256, spans,
    n_spans, and with ``mask`` the text with secrets masked as ``masked``.

    Spans are ``kind:start:end`` in code points, end exclusive, by start, then kind; base_sha256 is of
    the pattern spans alone. A null text counts as empty (masked: null). Null and repeated ids pass
    through; an input column named like a result is left out; an empty table gives no rows. Without
    any pattern match to learn from, the random model is even over all characters. Starts one job,
    which counts character steps (at most 9,000 numbers reach the driver).
    """
    table = ratios(transitions(docs, text))
    results = {"n_assign": "long", "n_access": "long", "n_hex": "long", "base_sha256": "string", "spans": "string", "n_spans": "long"}
    results |= {"masked": "string"} if mask else {}
    own = [f for f in docs.schema if f.name in (docs.columns if carry is None else carry)]
    own = [f for f in own if f.name not in results]
    picked = docs.select(F.col(text).alias("scanned"), *[F.col(f"`{f.name}`") for f in own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                given = part.column(0).to_pylist()
                texts = [t or "" for t in given]
                rows, covers = [], []
                for value, tokens in zip(texts, token_spans(texts, table), strict=True):
                    base = [(s, k, e) for s, k, e, *_ in base_spans(value)]
                    added = [(a, 3, b) for a, b in outside(tokens, base)]
                    every = sorted(base + added)
                    n = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                    digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                    rows.append((*n, digest, _joined(every), len(every)))
                    covers.append(every)
                columns = [pa.array(list(c)) for c in zip(*rows, strict=True)]
                if mask:
                    clean = [v and masked(v, c) for v, c in zip(given, covers, strict=True)]
                    columns.append(pa.array(clean, pa.string()))
                yield pa.record_batch(part.columns[1:] + columns, names=[*(f.name for f in own), *results])

    schema = T.StructType(list(own))
    for name, kind in results.items():
        schema = schema.add(name, kind)
    return picked.mapInArrow(run, schema)
