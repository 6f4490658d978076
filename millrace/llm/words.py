"""The words of a batch of texts as numpy arrays: places, hashes, hashes of runs of words.

A word is a maximal run of anything but the six ASCII white-space characters. Hashes are 64 bits and
the same in every process; two different runs of words share one with a chance of about 5e-20.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
CHUNK = 1 << 18
_BASE, _STEP, _SALT = 0x9E3779B97F4A7C55, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 (a one-to-one map)."""
    x = x ^ (x >> _S33)
    x *= _M1
    x ^= x >> _S33
    x *= _M2
    x ^= x >> _S33
    return x


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK), base, dtype=np.uint64)
        steps[0] = 1
        _powers[base] = have = np.cumprod(steps)
    return have[:n]


class Words:
    """``data``: all texts' UTF-8 bytes, each followed by a line feed. ``start``/``end``: the words'
    places in it. ``first``: number of words before each text, and of all. A null text is empty;
    with ``lower`` A to Z are lower-cased."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray, lower: bool = False):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        raw = pc.binary_join_element_wise(
            texts.cast(pa.large_binary()).fill_null(b""),
            pa.scalar(b"", pa.large_binary()),
            pa.scalar(b"\n", pa.large_binary()),
        )
        if isinstance(raw, pa.ChunkedArray):
            raw = raw.combine_chunks()
        offsets = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset :][: len(raw) + 1]
        empty = not len(raw) or raw.buffers()[2] is None
        self.offset = offsets if len(raw) else np.zeros(1, dtype=np.int64)
        self.data = np.zeros(0, np.uint8) if empty else np.frombuffer(raw.buffers()[2], np.uint8)
        self.data = self.data[: self.offset[-1]]
        if lower:
            self.data = self.data + ((self.data >= 65) & (self.data <= 90)).astype(np.uint8) * np.uint8(32)
        space = SPACE[self.data]
        before = np.ones(len(space), dtype=bool)
        before[1:] = space[:-1]
        self.start = np.flatnonzero(~space & before)
        self.end = np.flatnonzero(space & ~before)
        self.first = np.searchsorted(self.start, self.offset)

    @property
    def text_of(self) -> np.ndarray:
        """The number of the text each word stands in."""
        return np.repeat(np.arange(len(self.offset) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        out = np.empty(len(self.start), dtype=np.uint64)
        at = 0
        while at < len(out):
            origin = self.start[at]
            stop = max(at + 1, int(np.searchsorted(self.end, origin + CHUNK, side="right")))
            size = int(self.end[stop - 1] - origin)
            up = powers(_BASE, size)
            down = powers(pow(_BASE, -1, 1 << 64), size)
            sums = np.zeros(size + 1, dtype=np.uint64)
            np.cumsum((self.data[origin : origin + size].astype(np.uint64) + 1) * up, out=sums[1:])
            s, e = self.start[at:stop] - origin, self.end[at:stop] - origin
            out[at:stop] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(_SALT)
            at = stop
        return mix(out)

    def runs(self, size: int, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Where a run of ``size`` words of one text starts, and its hash."""
        hashes = self.hashes() if hashes is None else hashes
        text = self.text_of
        n = len(hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        where = np.flatnonzero(text[:n] == text[size - 1 :])
        total = np.zeros(n, dtype=np.uint64)
        for j in range(size):
            total *= np.uint64(_STEP)
            total += hashes[j : j + n]
        return where, mix(total[where])
