"""Names of columns that clash with none of a table's own."""

from __future__ import annotations

from collections.abc import Iterable


def free(name: str, taken: Iterable[str]) -> str:
    """``name``, lengthened until no column is called so in any case of letters."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name
