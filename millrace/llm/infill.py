"""Fill-in-middle documents: texts cut in three at drawn places and put together in another order.

Texts come as seekable frames. The places are drawn from the document's id alone, so a repeated task
draws the same; each is found by decompressing the one frame that holds it. The output is written as
frames again, read in order, so a text of any length passes through a task frame by frame. ``restored``
turns an output and its form into the text that it was made of.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.columns import free
from millrace.llm.frames import FRAME, FRAMES_ARROW, Frames

# The marks before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED, RATE, SUFFIX_FIRST = 42, 50, 80
RESULTS = {
    "n": T.LongType(), "form": T.StringType(), "prefix_chars": T.LongType(), "middle_chars": T.LongType(),
    "output": T.ArrayType(FRAME), "output_text": T.StringType(), "output_sha256": T.StringType(),
    "restored_sha256": T.StringType(),
}


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers below 2^32 for an id; a null id counts as no digits."""
    told = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(told[i : i + 8], 16) for i in range(0, 32, 8)]


class Infill:
    """One document: its form, its two places as (byte, code point), and its output."""

    def __init__(self, text: Frames, doc_id: int | None, seed: int, rate: int, suffix_first: int):
        self.text = text
        first, second, chance, order = draws(doc_id, seed)
        n = text.n_units
        low, high = sorted((first % (n + 1), second % (n + 1)))
        marked = any(text.find(m) >= 0 for m in (PREFIX, SUFFIX, MIDDLE)) if n else True
        if marked or chance % 100 >= rate:
            self.form, self.low, self.high = "plain", None, None
        else:
            self.form = "spm" if order % 100 < suffix_first else "psm"
            self.low, self.high = text.place(low), text.place(high)

    def output(self) -> Iterator[bytes]:
        read = self.text.stretch
        if self.form == "plain":
            yield from read()
            return
        low, high = self.low[0], self.high[0]
        prefix, suffix = (PREFIX, (0, low)), (SUFFIX, (high, None))
        for mark, part in (suffix, prefix) if self.form == "spm" else (prefix, suffix):
            yield mark
            yield from read(*part)
        yield MIDDLE
        yield from read(low, high)


def restored(output: Frames, form: str) -> Iterator[bytes]:
    """The text that an output of this form was made of.

    A text with a mark stays plain and no mark can begin inside another, so the first of each is it.
    """
    if form == "plain":
        yield from output.stretch()
        return
    first, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    other = output.find(second, len(first))
    middle = output.find(MIDDLE, other + len(second))
    one, two = (len(first), other), (other + len(second), middle)
    prefix, suffix = (two, one) if form == "spm" else (one, two)
    yield from output.stretch(*prefix)
    yield from output.stretch(middle + len(MIDDLE))
    yield from output.stretch(*suffix)


def _digest(chunks: Iterator[bytes]) -> str:
    told = hashlib.sha256()
    for chunk in chunks:
        told.update(chunk)
    return told.hexdigest()


def infilled(
    framed: DataFrame,
    results: tuple[str, ...] = ("n", "form", "prefix_chars", "middle_chars", "output"),
    id_col: str = "doc_id",
    seed: int = SEED,
    rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
    carry: tuple[str, ...] | None = None,
) -> DataFrame:
    """Per row of ``frames.framed``: the columns of ``carry`` (by default all but the frames), then
    ``results`` out of ``RESULTS``.

    ``n``: units of the text; ``form``: plain, psm or spm; ``prefix_chars`` and ``middle_chars``: code
    points, null if plain; ``output``: frames of the output; ``output_text``: the output itself;
    ``output_sha256`` and ``restored_sha256``: of the output, and of the text rebuilt from its frames.

    ``rate`` percent of documents are cut, ``suffix_first`` percent of these have the suffix first. No
    frames (a null or an empty text) make a plain, empty output. Rows with equal ids are cut at the
    same draws; a null id draws as one without digits. An input column named like a result is left
    out; an empty table gives an empty one.
    """
    own = [f for f in framed.schema if f.name in (framed.columns if carry is None else carry)]
    own = [f for f in own if f.name not in (*results, "frames")]
    digests = {"output", "restored_sha256"} & set(results)

    def row(doc_id: int | None, frames: list[dict] | None) -> dict:
        text = Frames(frames or ())
        made = Infill(text, doc_id, seed, rate, suffix_first)
        plain = made.form == "plain"
        out = {
            "n": text.n_units,
            "form": made.form,
            "prefix_chars": None if plain else made.low[1],
            "middle_chars": None if plain else made.high[1] - made.low[1],
        }
        written = Frames.of(made.output()) if digests else None
        if "output" in results:
            out["output"] = written.rows()
        if "output_text" in results:
            out["output_text"] = b"".join(made.output()).decode()
        if "output_sha256" in results:
            out["output_sha256"] = _digest(made.output())
        if "restored_sha256" in results:
            out["restored_sha256"] = _digest(restored(written, made.form))
        return out

    kinds = {"output": FRAMES_ARROW, "n": pa.int64(), "prefix_chars": pa.int64(), "middle_chars": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = [row(i, f.as_py()) for i, f in zip(ids, batch.column(1), strict=True)]
            made = [pa.array([r[c] for r in rows], kinds.get(c, pa.string())) for c in results]
            yield pa.record_batch([*batch.columns[2:], *made], names=[*(f.name for f in own), *results])

    schema = T.StructType(list(own))
    for c in results:
        schema = schema.add(c, RESULTS[c])
    names = [f.name for f in own]
    read = [F.col(id_col).alias(free("drawn", names)), F.col("frames").alias(free("read", names))]
    picked = framed.select(*read, *[F.col(f"`{n}`") for n in names])
    return picked.mapInArrow(run, schema)
