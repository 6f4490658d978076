import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

DOCUMENTS = (
    "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, block INT, n_words STRING, score STRING,"
    " chunk INT, row INT, kept STRING, spans STRING, a BIGINT, node STRING"
)


def prose(seed: int, words: int, stock: int = 400) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(stock)}" for _ in range(words))


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, an empty and a very long text, repeated rows, copies, and columns named like results."""
    body = prose(1, 80)
    more = (7, "x", "y", 8, 9, "z", "q", 10, "n")
    rows = [
        (1, body, "en", "s", 1, *more),
        (2, None, "en", None, None, *more),
        (3, "", None, "s", 0, *more),
        (4, prose(2, 60_000, 10**9) + " 漢字 é", "fr", "t", 5, *([None] * 9)),
        (5, body, "en", "s", 1, *more),
        (5, body, "en", "s", 1, *more),
        (None, body, "en", "s", 1, *more),
        (6, body + " extra", None, None, 1, *more),
        (7, " \t\n ", "en", "s", 4, *more),
        (8, "short one", "fr", "t", 9, *more),
        (9, "!!! 123", "fr", "t", 9, *more),
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
