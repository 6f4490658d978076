"""Token ids of whole texts by a public tokenizer, each distinct piece encoded once per worker.

The word tokenizer drops white space and encodes the pieces its pattern cuts out one by one, so a
text's ids are those of its pieces in order. Pieces are kept with their ids up to ``HELD`` per
worker, which holds them as long as it lives; a full store goes back to its first ``COMMON``, among
which are the most frequent ones. Texts with characters
that are not plain, for which Python's character classes may differ from the tokenizer's, and texts
with the marks of special tokens are encoded whole by the library.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
from collections.abc import Iterator

import numpy as np

KNOWN = 600_000
HELD, COMMON = 200_000, 100_000  # by the word tokenizer
#: What is plain: white space, printable ASCII, and Latin up to U+024F but for the letter that
#: lower-cases to two.
UNUSUAL = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\u012f\u0131-\u024f]")
PLAIN_BYTES = bytes([9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x100)])
LETTERS = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u02af\u2c65\u2c66"  # with the lower case of the latter
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
SPACES = r"\t\n\r "
CONTRACTIONS = "'(?:s|t|re|ve|m|ll|d)"
#: The word tokenizer's own pattern, for plain lower-case text.
PIECES = re.compile(f"[{LETTERS}]+|[{NUMBERS}]|{CONTRACTIONS}|[^{SPACES}{LETTERS}{NUMBERS}]+")


def unusual(text: str) -> bool:
    """Whether a text has characters that are not plain, or the start of a special token's mark."""
    if "<|" in text:
        return True
    try:
        return bool(text.encode("latin-1").translate(None, PLAIN_BYTES))
    except UnicodeEncodeError:
        return UNUSUAL.search(text) is not None


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


def _gaps(ids: list[bytes | None]) -> Iterator[int]:
    """Where a list has None."""
    at = -1
    for _ in range(ids.count(None)):
        at = ids.index(None, at + 1)
        yield at


class WordIds:
    """Encodes texts to little-endian unsigned 16-bit ids (the vocabulary has fewer than 65,536)."""

    def __init__(self, path: str):
        self.path = path
        self.model = library(path).model
        self.letters = dict(enumerate(byte_letters()))
        self.known: dict[str, bytes] = {}

    def fresh(self, piece: str) -> bytes:
        """The ids of one piece, from the library's model alone."""
        letters = piece.encode().decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.model.tokenize(letters)], dtype="<u2").tobytes()

    def whole(self, text: str) -> bytes:
        ids = library(self.path).encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u2").tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        known = self.known
        out = []
        for text in texts:
            if not text:
                out.append(b"")
            elif unusual(text):
                out.append(self.whole(text))
            else:
                pieces = PIECES.findall(text.lower())
                ids = [*map(known.get, pieces)]
                for i in _gaps(ids):
                    ids[i] = found = known.get(pieces[i]) or self.fresh(pieces[i])
                    known[pieces[i]] = found
                    if len(known) >= HELD:
                        known = self.known = dict(itertools.islice(known.items(), COMMON))
                out.append(b"".join(ids))
        return out


@functools.cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)
