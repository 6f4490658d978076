"""What the vector operators share: which vectors take part, unit vectors, a bounded sample."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """A vector that is not null, not zero, and whose components are all finite. Never null."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def usual_size(rows: DataFrame, vector: str) -> int:
    """The length that most vectors have (the smaller of equals); 0 without vectors."""
    sizes = rows.groupBy(F.size(vector).alias("size")).count().orderBy(F.desc("count"), "size")
    first = sizes.first()
    return first["size"] if first else 0


def sampled(rows: DataFrame, vector: str, by: str, n: int, total: int) -> np.ndarray:
    """About ``n`` vectors chosen by a hash of ``by`` (a matrix for the driver)."""
    draw = F.pmod(F.xxhash64(by, F.lit("sample")), F.lit(1 << 30))
    share = min(1.0, n / max(1, total))
    found = rows.where(draw < int(share * (1 << 30))).orderBy(by).select(vector).toArrow()
    return matrix(found.column(0))


def matrix(vectors: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as double-precision rows."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1) if len(vectors) else np.zeros((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares neither vanish nor overflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
