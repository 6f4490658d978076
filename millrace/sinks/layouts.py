"""Stored layouts that later work profits from: buckets that save a shuffle, periods that are replaced alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bucketed(frame: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
    """Store a table in buckets of a key, sorted by it; an existing table is refused.

    Rows are dealt to their buckets before the write, so a bucket is one file and not one per task.
    Two tables with equal ``buckets`` join or group on the key without a shuffle, which a table that is
    joined again and again earns back. Take enough buckets for one to fit a task; all rows of a key
    share one, so a key with a large share of all rows should be joined by ``salted_join`` instead.
    """
    dealt = frame.repartition(buckets, key)
    dealt.write.mode("errorifexists").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return frame.sparkSession.table(table)


def bucketed_join(left: DataFrame, right: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Join two tables of ``write_bucketed`` in their buckets: no Exchange on either side."""
    return left.hint("merge").join(right.hint("merge"), on, how)


def write_by_period(frame: DataFrame, path: str, time: str, unit: str = "month", ways: int = 4) -> str:
    """Store rows in a folder per ``period``, the day, month or year of a time; rows without one go to
    the default folder.

    Rows are spread by period and a part of their hash, so a busy period is written by ``ways`` tasks,
    as many files.
    """
    _by_period(frame, time, unit, ways).write.mode("errorifexists").partitionBy("period").parquet(path)
    return path


def replace_periods(frame: DataFrame, path: str, time: str, unit: str = "month", ways: int = 4) -> str:
    """Put corrected rows in the place of all rows of their periods; other periods' files stay untouched.

    The periods replaced are those that occur in ``frame``. A repeated run gives the same table.
    """
    writer = _by_period(frame, time, unit, ways).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(path)
    return path


def read_periods(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """The stored rows; with ``wanted``, a table with a column ``period``, those of its periods alone.

    The periods found in ``wanted`` prune the scan as it starts.
    """
    rows = spark.read.parquet(path)
    return rows if wanted is None else rows.join(wanted.select("period").distinct(), "period", "left_semi")


def _by_period(frame: DataFrame, time: str, unit: str, ways: int) -> DataFrame:
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in frame.columns]), F.lit(ways))
    return frame.withColumn("period", F.to_date(F.date_trunc(unit, time))).repartition("period", part)
