"""Label stream rows from a static lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import or_else
from millrace.functions.fixed import UNMAPPED
from millrace.operators.joins import (
    BROADCAST_BYTES,
    BROADCAST_ROWS,
    SALTS,
    fits_broadcast,
    salted_join,
)


def enrich_stream(
    rows: DataFrame,
    lookup: DataFrame,
    on: str = "product_id",
    label: str = "category",
    keep: Sequence[str] = ("sale_id", "product_id", "amount", "sold_at"),
    fallback: str = UNMAPPED,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    hot: Sequence[tuple] = (),
    salts: int = SALTS,
) -> DataFrame:
    """``joins.enrich`` for a stream. Starts a job that looks at no more of the lookup than decides.

    A lookup that measures small is broadcast; a larger one is joined by shuffle. AQE leaves stream
    batches alone, so name keys known to be ``hot``: beside a larger lookup their rows are spread
    over ``salts`` partitions each, and only their lookup rows are repeated. A lookup that
    outgrows the bound changes neither the result nor, without hot keys, what ``require_boundary``
    compares.
    """
    pairs = lookup.select(on, label)
    if fits_broadcast(pairs, max_rows, max_bytes):
        joined = rows.join(F.broadcast(pairs), on=on, how="left")
    elif hot:
        joined = salted_join(rows, pairs, on, "left", salts=salts, hot=hot)
    else:
        joined = rows.join(pairs, on=on, how="left")
    return joined.select(*keep, or_else(F.col(label), fallback).alias(label))
