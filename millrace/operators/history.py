"""Version histories from snapshots: what changed when, as rows with a time of validity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def versions(snapshots: DataFrame, key: str, time: str) -> DataFrame:
    """Rows that stay the same from snapshot to snapshot, folded into one with ``valid_from``,
    ``valid_to`` and ``is_current``.

    ``snapshots`` hold all keys of each time at which one was taken. A version begins with the first
    snapshot that has it and ends when one has other values, or lacks the key; one that comes back
    later is a new version. The last snapshot's versions are current and have no end. Values are
    compared with nulls equal. A key may be null; rows that a snapshot repeats count once; of several
    rows with one key and time the greatest stays.

    A key's rows pass through one task, as many as there are snapshots. The times of all snapshots,
    a row each, are numbered on their own and joined back.
    """
    values = [c for c in snapshots.columns if c not in (key, time)]
    row = F.struct(*[F.col(f"`{c}`") for c in values])
    once = snapshots.where(F.col(time).isNotNull()).groupBy(key, time).agg(F.max(row).alias("_row"))
    taken = once.select(time).distinct()
    in_turn = Window.orderBy(time)  # over the snapshots' times alone
    taken = taken.select(
        time, F.row_number().over(in_turn).alias("_turn"), F.lead(time).over(in_turn).alias("_next")
    )
    by_key = Window.partitionBy(key).orderBy("_turn")
    before = F.lag(F.struct("_turn", "_row")).over(by_key)
    gap = before.isNull() | (before["_turn"] != F.col("_turn") - 1)
    opens = gap | ~before["_row"].eqNullSafe(F.col("_row"))
    numbered = once.join(taken, time).withColumn("_version", F.sum(opens.cast("int")).over(by_key))
    folded = numbered.groupBy(key, "_version").agg(
        F.min(time).alias("valid_from"), F.max_by("_next", "_turn").alias("valid_to"), F.max("_row").alias("_row")
    )
    return folded.select(
        key, *[F.col("_row")[c].alias(c) for c in values], "valid_from", "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )
