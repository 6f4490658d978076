"""Ranks and running totals over all rows, without putting them into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.scratch import cut_lineage


def running_totals(frame: DataFrame, *order: str, measure: str | None = None) -> DataFrame:
    """The rows with ``position`` from 1 in ascending order, and with ``measure`` its ``running_total``.

    Rows are cut into ranges of the order, which is made total by the rest of the row, so a value that
    many rows share is cut too. Each range is numbered and summed by itself; the sums of the ranges, a
    row each, are added up and joined back. Nulls come first. Rows alike in every column take
    neighbouring positions. The ranges are stored in the shared folder, since a sampled range may not
    be drawn twice.
    """
    rest = [c for c in frame.columns if c not in order]
    keys = [*order, *rest]
    ranged = frame.repartitionByRange(*[F.col(f"`{c}`").asc() for c in keys])
    ranged = cut_lineage(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    amount = F.lit(0) if measure is None else F.col(measure)
    sums = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"), F.sum(amount).alias("_sum"))
    kind = sums.schema["_sum"].dataType
    none = F.lit(0).cast(kind)
    # As many rows as there are shuffle partitions; each range takes the sums of those before it.
    every = sums.agg(F.collect_list(F.struct("_range", "_rows", "_sum")).alias("every"))
    own = every.select(F.explode("every").alias("own"), "every")
    before = F.filter("every", lambda r: r["_range"] < F.col("own._range"))
    offsets = own.select(
        F.col("own._range"),
        F.aggregate(before, F.lit(0).cast("long"), lambda a, r: a + r["_rows"]).alias("_skipped"),
        F.aggregate(before, none, lambda a, r: (a + F.coalesce(r["_sum"], none)).cast(kind)).alias("_carried"),
    )
    within = Window.partitionBy("_range").orderBy(*[F.col(f"`{c}`").asc() for c in keys])
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = ranged.join(offsets, "_range")
    told = told.withColumn("position", F.col("_skipped") + F.row_number().over(within))
    if measure is not None:
        total = F.col("_carried") + F.coalesce(F.sum(measure).over(upto), none)
        told = told.withColumn("running_total", total)
    return told.drop("_range", "_skipped", "_carried")


def page(numbered: DataFrame, number: int, size: int) -> DataFrame:
    """Page ``number``, from 1, of rows with a ``position``."""
    return numbered.where(F.col("position").between((number - 1) * size + 1, number * size))
