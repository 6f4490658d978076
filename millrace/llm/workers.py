"""Memory of Python workers, which live on from task to task and from stage to stage."""

from __future__ import annotations

import ctypes

import pyarrow as pa

_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of most Linux systems has it


def give_back() -> None:
    """Return to the system what earlier tasks used and left with Arrow or the C library.

    Each operator calls it as a task or group begins; otherwise a worker keeps the most that any
    stage before has used, beside what the stage at hand needs.
    """
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)
