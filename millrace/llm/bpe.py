"""Exact byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

One Aho-Corasick pass over a piece finds the longest token that starts at each place. The encoder takes
the longest at each step if merging would keep a border between it and the token before, else the
longest token that is a prefix of it; where none fits, the place is closed and the last token is taken
back. Whether a border lasts between two tokens depends on the two alone, so it is worked out once per
pair. Each place is closed at most once, so a piece takes linear time however long it is.

Pieces are those of the byte-level tokenizer's own pattern. Texts with characters outside the plain
set of ``tokens.unusual`` are cut by the library, whose character classes decide there.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.tokens import (
    CONTRACTIONS,
    KNOWN,
    LETTERS,
    NUMBERS,
    SPACES,
    byte_letters,
    library,
    public_path,
    unusual,
)

PAIRS = 300_000
ROWS = 128
#: The byte-level tokenizer's own pattern, for plain text.
PIECES = re.compile(
    f" ?[{LETTERS}]+|{CONTRACTIONS}| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|"
    f"[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)


class Encoder:
    """Built from a byte-level BPE file; holds the tables and the ids of pieces met before."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.path = path
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        marks = "|".join(re.escape(s) for s in sorted(self.specials, key=len, reverse=True))
        self.mark = re.compile(f"({marks})") if marks else None
        size = 1 + max([*self.vocab.values(), *self.specials.values()])
        self.size = [0] * size
        self.rank = [-1] * size
        self.halves: list[tuple[int, int] | None] = [None] * size
        self.merge: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, whole = self.vocab[left], self.vocab[right], self.vocab[left + right]
            self.merge[a, b] = rank
            if self.halves[whole] is None:
                self.halves[whole], self.rank[whole] = (a, b), rank
        self.shorter = [-1] * size
        self.matcher = ahocorasick.Automaton()
        for token, i in self.vocab.items():
            self.size[i] = len(token)
            self.matcher.add_word(token, (len(token), i))
            self.shorter[i] = next(
                (self.vocab[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in self.vocab), -1
            )
        self.matcher.make_automaton()
        letters = byte_letters()
        self.letters = {b: letters[b] for b in range(256)}
        self.known: dict[str, bytes] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        raw = {c: b for b, c in enumerate(letters)}
        words = [b""] * size
        for token, i in self.vocab.items():
            words[i] = bytes(raw[c] for c in token)
        for mark, i in self.specials.items():
            words[i] = mark.encode()
        self.bytes = np.frombuffer(b"".join(words), np.uint8)
        self.offset = np.concatenate(([0], np.cumsum([len(w) for w in words])))

    def lasting(self, left: int, right: int) -> bool:
        """Whether merging in order of rank leaves a border between two neighbouring tokens.

        Merges at the border are undone from the last to the first; each time, the two parts that
        touch must not have a merge that would have come before the one undone. Of equal merges
        the one further left comes first.
        """
        key = (left, right)
        found = self.pairs.get(key)
        if found is None:
            rank, halves, merge = self.rank, self.halves, self.merge
            before = len(merge) + 1
            while True:
                joined = merge.get((left, right))
                if joined is not None and joined < before:
                    found = False
                    break
                if rank[left] > rank[right]:
                    before, left = rank[left], halves[left][1]
                elif rank[right] >= 0:
                    before, right = rank[right] + 1, halves[right][0]
                else:
                    found = True
                    break
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            self.pairs[key] = found
        return found

    def piece(self, letters: str) -> list[int]:
        """The ids of one piece, given in byte letters."""
        whole = self.vocab.get(letters)
        if whole is not None:
            return [whole]
        n = len(letters)
        longest = [-1] * n
        for end, (length, token) in self.matcher.iter(letters):
            longest[end - length + 1] = token  # ends rise, so the longest comes last
        is_open = bytearray(b"\x01") * (n + 1)
        size, shorter, lasting = self.size, self.shorter, self.lasting
        ids: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            end = at + size[token]
            if is_open[end] and (not ids or lasting(ids[-1], token)):
                ids.append(token)
                at = end
                token = longest[at] if at < n else -1
                continue
            token = shorter[token]
            if token < 0:
                is_open[at] = 0
                token = ids.pop()
                at -= size[token]
        return ids

    def fresh(self, piece: str) -> bytes:
        letters = piece.encode().decode("latin-1").translate(self.letters)
        return np.array(self.piece(letters), dtype="<u4").tobytes()

    def plain(self, text: str) -> bytes:
        known, out = self.known, []
        for piece in PIECES.findall(text):
            ids = known.get(piece)
            if ids is None:
                ids = self.fresh(piece)
                if len(known) < KNOWN and len(piece) < 64:
                    known[piece] = ids
            out.append(ids)
        return b"".join(out)

    def cut_by_library(self, text: str) -> bytes:
        pieces = library(self.path).pre_tokenizer.pre_tokenize_str(text)
        return b"".join([np.array(self.piece(p), dtype="<u4").tobytes() for p, _ in pieces])

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if not unusual(text):
            return self.plain(text)
        out = []
        for part in self.mark.split(text) if self.mark else [text]:
            if part in self.specials:
                out.append(np.array([self.specials[part]], dtype="<u4").tobytes())
            elif part:
                out.append(self.cut_by_library(part) if unusual(part) else self.plain(part))
        return b"".join(out)

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The UTF-8 texts of ids as ``encode`` gives them; broken characters are replaced."""
        every = np.frombuffer(b"".join(ids), dtype="<u4")
        begin = self.offset[every]
        length = self.offset[every + 1] - begin
        ends = np.cumsum(length)
        place = np.arange(ends[-1] if len(ends) else 0)
        place += np.repeat(begin - ends + length, length)
        data = self.bytes[place].tobytes()
        stops = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids])))]
        parts = [data[a:b] for a, b in zip(stops[:-1], stops[1:], strict=True)]
        return [p.decode("utf-8", "replace").encode() for p in parts]


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encoded(docs: DataFrame, path: str | None = None, texts: bool = False) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256; with ``texts`` also ids and decoded.

    The ids are those of the tokenizers library without added special tokens; marks of special
    tokens inside a text become those tokens, as there. A null text counts as empty, which has no
    ids. Ids may be null or repeated; further columns are ignored; an empty table gives no rows.
    """
    path = path or public_path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids = [tool.encode(t) for t in part.column(1).to_pylist()]
                back = tool.decode(ids)
                columns = {
                    "doc_id": part.column(0).cast(pa.int64()),
                    "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                    "decoded_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in back]),
                }
                if texts:
                    columns["ids"] = pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32()))
                    columns["decoded"] = pa.array([x.decode() for x in back], pa.string())
                yield pa.record_batch(columns)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(
        run, schema + (", ids array<int>, decoded string" if texts else "")
    )
