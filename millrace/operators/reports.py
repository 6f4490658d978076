"""Grouped, global and sorted reports. Sums and counts combine before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import or_else, pieces
from millrace.functions.fixed import UNMAPPED
from millrace.scratch import cut_lineage
from millrace.sources.tables import numbered


def totals_by(frame: DataFrame, *keys: str, measure: str = "amount") -> DataFrame:
    """Row count and exact sum per group; with no keys, one row for everything."""
    return frame.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sales"), F.sum(measure).alias("total")
    )


def category_totals(enriched: DataFrame, label: str = "category") -> DataFrame:
    return totals_by(enriched, label)


def daily_totals(
    enriched: DataFrame, time: str = "sold_at", label: str = "category", measure: str = "amount"
) -> DataFrame:
    """Total and largest sale per calendar day and label."""
    return enriched.groupBy(F.to_date(time).alias("sale_date"), label).agg(
        F.sum(measure).alias("total"), F.max(measure).alias("largest_sale")
    )


def daily_totals_through_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    on: str = "product_id",
    time: str = "sold_at",
    label: str = "category",
    measure: str = "amount",
    fallback: str = UNMAPPED,
) -> DataFrame:
    """``daily_totals(enrich(...))`` summed per key and day before the join.

    A hot key shrinks to one row per day before anything is shuffled.
    """
    per_key = rows.groupBy(on, F.to_date(time).alias("sale_date")).agg(
        F.sum(measure).alias("total"), F.max(measure).alias("largest_sale")
    )
    total_type = per_key.schema["total"].dataType
    joined = per_key.join(lookup.select(on, label), on=on, how="left")
    return joined.groupBy("sale_date", or_else(F.col(label), fallback).alias(label)).agg(
        F.sum("total").cast(total_type).alias("total"),
        F.max("largest_sale").alias("largest_sale"),
    )


def profile_by(frame: DataFrame, key: str, measure: str, distinct: str) -> DataFrame:
    """Count, smallest, mean, largest value and number of distinct values per group.

    A null key is a group of its own. ``rows`` counts rows, ``known`` only non-null measures.
    """
    return frame.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(measure).alias("known"),
        F.min(measure).alias("smallest"),
        F.avg(measure).alias("mean"),
        F.max(measure).alias("largest"),
        F.count_distinct(distinct).alias("distinct_values"),
    )


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """How often each space-separated word occurs. Batch or stream; whole lines."""
    return lines.select(pieces(F.col(column), " ").alias("word")).groupBy("word").count()


def tag_rows(frame: DataFrame, key: str, tags: str, separator: str = "|") -> DataFrame:
    """One row per key and tag out of a delimited list."""
    return frame.select(key, pieces(F.col(tags), separator).alias("tag"))


def sorted_rows(frame: DataFrame, *keys: str) -> DataFrame:
    """A total order by the keys.

    Ties are ordered by the row and its input partition, so range partitioning can cut through
    a key that holds a large part of the rows instead of sending it all to one task.
    """
    plain = [f.name for f in frame.schema if "map<" not in f.dataType.simpleString()]
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in plain], F.spark_partition_id())
    return frame.withColumn("_tie", tie).orderBy(*keys, "_tie").drop("_tie")


def preview(frame: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in the given order; each task keeps only ``n`` rows."""
    return frame.orderBy(*order).limit(n)


def calendar_totals(
    frame: DataFrame, time: str = "sold_at", measure: str = "amount"
) -> DataFrame:
    """Totals for every day between the first and the last, days without sales included.

    Rows without a time are one row more, without a day, so no total is lost. Starts a job: the daily totals are stored, their end days read back, and ``spark.range``
    generates the days between.
    """
    per_day = cut_lineage(
        totals_by(frame.withColumn("sale_date", F.to_date(time)), "sale_date", measure=measure),
        "per-day",
    )
    ends = per_day.agg(F.min("sale_date"), F.max("sale_date")).first()
    days = (ends[1] - ends[0]).days + 1 if ends[0] is not None else 0
    start = F.lit(ends[0]).cast("date")
    calendar = numbered(frame.sparkSession, days).select(
        F.date_add(start, F.col("id").cast("int")).alias("sale_date")
    )
    dated = calendar.join(per_day, "sale_date", "left").select(
        "sale_date", F.coalesce("sales", F.lit(0)).alias("sales"), "total"
    )
    return dated.unionByName(per_day.where(F.col("sale_date").isNull()))
