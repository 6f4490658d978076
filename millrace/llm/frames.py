"""Texts as seekable compressed frames: independent zstandard frames with cumulative counts.

A frame holds up to ``FRAME_BYTES`` of a text, cut between code points, and says how many units, code
points and bytes the text has up to the frame's end. To find a unit, its frame is looked up in the
counts and only that one is decompressed; a stretch of the text is read frame by frame, so no reader
holds more than one frame.

A unit is a token of ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+`` matched left to right:
it begins with the text, or where white space follows something else.
"""

from __future__ import annotations

import bisect
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.columns import free
from millrace.llm.words import SPACE

FRAME_BYTES = 1 << 16
LEVEL = 1
FRAME = T.StructType(
    [T.StructField("data", T.BinaryType())]
    + [T.StructField(c, T.LongType()) for c in ("units", "chars", "bytes")]
)
FRAMES_ARROW = pa.list_(
    pa.struct([("data", pa.binary()), ("units", pa.int64()), ("chars", pa.int64()), ("bytes", pa.int64())])
)


def _starts(data: np.ndarray) -> np.ndarray:
    """Where units begin after the first byte."""
    space = SPACE[data]
    return np.flatnonzero(space[1:] & ~space[:-1]) + 1


class Frames:
    """One text as frames. ``units``, ``chars`` and ``bytes``: counts up to each frame's end."""

    def __init__(self, frames: Iterable[dict] = ()):
        self.data: list[bytes] = []
        self.units: list[int] = []
        self.chars: list[int] = []
        self.bytes: list[int] = []
        for f in frames:
            self.data.append(f["data"])
            self.units.append(f["units"])
            self.chars.append(f["chars"])
            self.bytes.append(f["bytes"])

    @classmethod
    def of(cls, chunks: Iterable[bytes], size: int = FRAME_BYTES) -> Frames:
        """Frames of a UTF-8 text that comes in chunks of any size; ``size`` is four at least."""
        out, press = cls(), zstandard.ZstdCompressor(level=LEVEL)
        held, open_unit, n = b"", False, [0, 0, 0]
        for chunk in itertools.chain(chunks, (None,)):
            held, at = held + (chunk or b""), 0
            while len(held) - at > size or (chunk is None and at < len(held)):
                cut = min(at + size, len(held))
                while cut < len(held) and held[cut] & 0xC0 == 0x80:
                    cut -= 1
                data, at = held[at:cut], cut
                raw = np.frombuffer(data, np.uint8)
                begins = not n[2] or (bool(SPACE[raw[0]]) and not open_unit)
                n[0] += len(_starts(raw)) + begins
                n[1] += int(np.count_nonzero((raw & 0xC0) != 0x80))
                n[2] += len(raw)
                open_unit = bool(SPACE[raw[-1]])
                out.data.append(press.compress(data))
                out.units.append(n[0])
                out.chars.append(n[1])
                out.bytes.append(n[2])
            held = held[at:]
        return out

    def rows(self) -> list[dict]:
        columns = zip(self.data, self.units, self.chars, self.bytes, strict=True)
        return [{"data": d, "units": u, "chars": c, "bytes": b} for d, u, c, b in columns]

    @property
    def n_units(self) -> int:
        return self.units[-1] if self.units else 0

    @property
    def n_bytes(self) -> int:
        return self.bytes[-1] if self.bytes else 0

    @property
    def n_chars(self) -> int:
        return self.chars[-1] if self.chars else 0

    def frame(self, i: int) -> bytes:
        return zstandard.ZstdDecompressor().decompress(self.data[i])

    def place(self, unit: int) -> tuple[int, int]:
        """The byte and the code point at which a unit, counted from 0, begins; from the last on, the end."""
        if unit >= self.n_units:
            return self.n_bytes, self.n_chars
        i = bisect.bisect_right(self.units, unit)
        before, chars, offset = (self.units[i - 1], self.chars[i - 1], self.bytes[i - 1]) if i else (0, 0, 0)
        raw = np.frombuffer(self.frame(i), np.uint8)
        starts = _starts(raw)
        if self.units[i] - before > len(starts):  # the frame's first byte begins a unit
            starts = np.concatenate(([0], starts))
        at = int(starts[unit - before])
        return offset + at, chars + int(np.count_nonzero((raw[:at] & 0xC0) != 0x80))

    def stretch(self, low: int = 0, high: int | None = None) -> Iterator[bytes]:
        """The bytes from ``low`` up to ``high``, in order, a frame at a time."""
        high = self.n_bytes if high is None else high
        i = bisect.bisect_right(self.bytes, low)
        while i < len(self.data) and low < high:
            first = self.bytes[i - 1] if i else 0
            yield self.frame(i)[low - first : high - first]
            low = self.bytes[i]
            i += 1

    def find(self, mark: bytes, low: int = 0) -> int:
        """Where a short mark first stands from ``low`` on, in bytes; -1 if nowhere."""
        tail, at = b"", low
        for part in self.stretch(low):
            found = (tail + part).find(mark)
            if found >= 0:
                return at - len(tail) + found
            at += len(part)
            tail = (tail + part)[-(len(mark) - 1) :] if len(mark) > 1 else b""
        return -1


def framed(docs: DataFrame, text: str = "text", carry: tuple[str, ...] | None = None) -> DataFrame:
    """The columns of ``carry`` (by default all but the text) and ``frames``, the text's frames in order.

    A null or an empty text has no frames. An input column called ``frames`` is left out. Rows stay
    as they are, repeated ones and nulls included; an empty table gives an empty one.
    """
    own = [f for f in docs.schema if f.name in (docs.columns if carry is None else carry)]
    own = [f for f in own if f.name not in (text, "frames")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            rows = [Frames.of([t.as_py().encode()] if t.is_valid else []).rows() for t in texts]
            yield pa.record_batch(
                [*batch.columns[1:], pa.array(rows, FRAMES_ARROW)], names=[*(f.name for f in own), "frames"]
            )

    schema = T.StructType(list(own)).add("frames", T.ArrayType(FRAME))
    names = [f.name for f in own]
    picked = docs.select(F.col(text).alias(free("framed", names)), *[F.col(f"`{n}`") for n in names])
    return picked.mapInArrow(run, schema)
