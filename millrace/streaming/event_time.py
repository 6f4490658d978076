"""Event-time windows and joins on streams, with watermarks that bound the state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def watermarked(stream: DataFrame, time: str, delay: str) -> DataFrame:
    """Declare how late rows may come. A zone-less time becomes a timestamp, as Spark requires."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def window_counts(
    stream: DataFrame, time: str, size: str, *keys: str, slide: str | None = None
) -> DataFrame:
    """Rows per fixed or sliding window and key."""
    return _flat(stream.groupBy(F.window(time, size, slide or size), *keys), "window", *keys)


def session_counts(stream: DataFrame, time: str, gap: str, *keys: str) -> DataFrame:
    """Rows per key and session, a session ending once nothing came for longer than ``gap``."""
    return _flat(stream.groupBy(F.session_window(time, gap), *keys), "session_window", *keys)


def busiest(stream: DataFrame, time: str, part: str, whole: str, *keys: str) -> DataFrame:
    """Per long window and key the highest count of its short windows, and how many of these had rows.

    Both windows stand in one query: a short window's own time carries the watermark on, and the long
    one closes once it is past all short ones. Append mode only.
    """
    counts = stream.groupBy(F.window(time, part), *keys).agg(F.count(F.lit(1)).alias("events"))
    again = counts.groupBy(F.window(F.window_time("window"), whole), *keys)
    return again.agg(F.max("events").alias("busiest"), F.count(F.lit(1)).alias("parts")).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "busiest", "parts"
    )


def _flat(grouped, window: str, *keys: str) -> DataFrame:
    return grouped.agg(F.count(F.lit(1)).alias("events")).select(
        F.col(f"{window}.start").alias("window_start"),
        F.col(f"{window}.end").alias("window_end"),
        *keys,
        "events",
    )


def follow_ups(
    first: DataFrame,
    second: DataFrame,
    on: str,
    first_time: str,
    second_time: str,
    within_seconds: int,
) -> DataFrame:
    """Pairs of rows with equal keys where the second came within a time span after the first.

    Both sides need a watermark and distinct column names apart from ``on``. Time joins the key in
    span-wide slots: a first row goes to its own and the next slot, a second row to its own, so
    they meet exactly once, and the rows of one busy key spread over many partitions.
    """

    span = F.lit(within_seconds * 1_000_000).cast("bigint")

    def slot(column: Column) -> Column:
        at = F.unix_micros(column)
        return at - F.pmod(at, span)

    own = slot(F.col(first_time))
    openers = first.withColumn("_slot", F.explode(F.array(own, own + span)))
    closers = second.withColumn("_closer_slot", slot(F.col(second_time))).withColumnRenamed(
        on, "_closer_key"
    )
    condition = (
        (F.col(on) == F.col("_closer_key"))
        & (F.col("_slot") == F.col("_closer_slot"))
        & (F.col(second_time) >= F.col(first_time))
        & (
            F.col(second_time)
            <= F.col(first_time) + F.expr(f"INTERVAL {int(within_seconds)} SECONDS")
        )
    )
    return openers.join(closers, condition, "inner").drop("_slot", "_closer_slot", "_closer_key")
