"""Data checks as DataFrames of violations or one-row metrics.

Nothing is collected to compare: both sides are tagged, stacked and grouped, which costs one
shuffle with partial aggregation instead of a join per direction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from millrace.functions.expressions import is_blank

COPIES = 10_000


# --- inputs --------------------------------------------------------------------------------------


def schema_differences(frame: DataFrame, expected: StructType | str) -> list[str]:
    """What a declared schema and a frame disagree on: names and types. Reads no data."""
    wanted = StructType.fromDDL(expected) if isinstance(expected, str) else expected
    have = {f.name: f.dataType for f in frame.schema}
    want = {f.name: f.dataType for f in wanted}
    return (
        [f"missing column {n}" for n in want if n not in have]
        + [f"unexpected column {n}" for n in have if n not in want]
        + [
            f"column {n} is {have[n].simpleString()}, not {want[n].simpleString()}"
            for n in want
            if n in have and have[n] != want[n]
        ]
    )


def input_summary(frame: DataFrame, expected: StructType | str) -> DataFrame:
    """One row: how many rows arrived and whether the columns are the declared ones."""
    problems = schema_differences(frame, expected)
    return frame.agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "schema_problems", F.lit(len(problems)).cast("bigint")
    )


def blank_keys(lookup: DataFrame, key: str = "product_id") -> DataFrame:
    """Lookup rows whose key is null or empty."""
    return lookup.where(is_blank(F.col(key)))


def repeated_keys(frame: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return (
        frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
    )


def lookup_problems(lookup: DataFrame, key: str = "product_id") -> DataFrame:
    """One row that must be all zero before a lookup is joined."""
    per_key = lookup.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    blank = is_blank(F.col(key))
    return per_key.agg(
        F.coalesce(F.sum(F.when(blank, F.col("copies"))), F.lit(0)).alias("blank_key_rows"),
        F.count_if(F.col("copies") > 1).alias("repeated_keys"),
    )


# --- reconciliation ------------------------------------------------------------------------------


def reconcile(cleaned: DataFrame, reason: str = "reject_reason") -> DataFrame:
    """One row from one pass: input rows, accepted rows and rejected rows."""
    return cleaned.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(F.col(reason).isNull()).alias("accepted_rows"),
        F.count(reason).alias("rejected_rows"),
    )


def reasons(rejected_rows: DataFrame, reason: str = "reject_reason") -> DataFrame:
    return rejected_rows.groupBy(reason).agg(F.count(F.lit(1)).alias("rejected_rows"))


def split_problems(
    raw: DataFrame, accepted_rows: DataFrame, rejected_rows: DataFrame, key: str = "sale_id"
) -> DataFrame:
    """Keys that did not end up on exactly one side as often as they came in. Empty when right.

    Compares stored outputs, so it also finds rows lost or repeated on the way to storage.
    """
    sides = (
        _tagged(raw, "input", key)
        .unionByName(_tagged(accepted_rows, "accepted", key))
        .unionByName(_tagged(rejected_rows, "rejected", key))
    )
    counts = sides.groupBy(key).agg(
        *[
            F.count_if(F.col("_side") == side).alias(f"{side}_rows")
            for side in ("input", "accepted", "rejected")
        ]
    )
    return counts.where(F.col("input_rows") != F.col("accepted_rows") + F.col("rejected_rows"))


def population(before: DataFrame, after: DataFrame, key: str = "sale_id") -> DataFrame:
    """One row: keys a step lost, invented, or gave a different number of rows."""
    sides = _tagged(before, "before", key).unionByName(_tagged(after, "after", key))
    counts = sides.groupBy(key).agg(
        F.count_if(F.col("_side") == "before").alias("n_before"),
        F.count_if(F.col("_side") == "after").alias("n_after"),
    )
    return counts.agg(
        F.count_if(F.col("n_after") == 0).alias("lost_keys"),
        F.count_if(F.col("n_before") == 0).alias("invented_keys"),
        F.count_if(
            (F.least("n_before", "n_after") > 0) & (F.col("n_before") != F.col("n_after"))
        ).alias("recounted_keys"),
    )


def totals_kept(
    fine: DataFrame, coarse: DataFrame, fine_measure: str = "amount", coarse_measure: str = "total"
) -> DataFrame:
    """One row: the grand total before and after the grain changed, and what was lost.

    Totals keep all their digits: whole numbers are summed as decimals, and both sums are compared in
    the wider scale of the two. Only a binary fraction on either side makes both doubles.
    """
    before = fine.agg(F.sum(_exact(fine, fine_measure)).alias("total"))
    after = coarse.agg(F.sum(_exact(coarse, coarse_measure)).alias("total"))
    kinds = [side.schema["total"].dataType for side in (before, after)]
    decimals = all(isinstance(kind, T.DecimalType) for kind in kinds)
    kind = T.DecimalType(38, max(k.scale for k in kinds)) if decimals else T.DoubleType()
    sides = [
        side.select(F.lit(name).alias("_side"), F.col("total").cast(kind))
        for name, side in (("before", before), ("after", after))
    ]
    return (
        sides[0]
        .unionByName(sides[1])
        .agg(
            F.max(F.when(F.col("_side") == "before", F.col("total"))).alias("total_before"),
            F.max(F.when(F.col("_side") == "after", F.col("total"))).alias("total_after"),
        )
        .withColumn("difference", F.col("total_before") - F.col("total_after"))
    )


def _exact(frame: DataFrame, measure: str) -> Column:
    whole = isinstance(frame.schema[measure].dataType, T.IntegralType)
    return F.col(measure).cast("decimal(20,0)") if whole else F.col(measure)


def stored_once(stored: DataFrame, key: str = "sale_id") -> DataFrame:
    """One row: stored rows, distinct keys, and keys stored more than once."""
    per_key = stored.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(
        F.sum("copies").alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("copies") > 1).alias("repeated_keys"),
    )


# --- comparison ----------------------------------------------------------------------------------


def row_differences(first: DataFrame, second: DataFrame) -> DataFrame:
    """Distinct rows that the two frames hold a different number of times. Empty when equal.

    Columns are matched by name, null equals null, and order plays no part. ``surplus`` is
    positive where the first frame has more copies.
    """
    names = first.columns
    if set(names) != set(second.columns):
        raise ValueError(f"columns differ: {sorted(names)} and {sorted(second.columns)}")
    stacked = first.withColumn("_side", F.lit(1)).unionByName(
        second.select(*names).withColumn("_side", F.lit(-1))
    )
    return (
        stacked.groupBy(*[F.col(f"`{n}`") for n in names])
        .agg(F.sum("_side").alias("surplus"))
        .where(F.col("surplus") != 0)
    )


def same_rows(first: DataFrame, second: DataFrame) -> bool:
    """Whether both frames hold the same rows equally often. Starts a job."""
    return row_differences(first, second).isEmpty()


def report_differences(first: DataFrame, second: DataFrame, key: str = "category") -> DataFrame:
    """Report rows that differ, and keys that either report holds more than once."""
    differing = row_differences(first, second).select(key).withColumn("problem", F.lit("differs"))
    repeated = (
        repeated_keys(first, key)
        .unionByName(repeated_keys(second, key))
        .select(key)
        .withColumn("problem", F.lit("repeated"))
    )
    return differing.unionByName(repeated).distinct()


def same_report(first: DataFrame, second: DataFrame, key: str = "category") -> bool:
    """Whether two reports agree, one row per key, in any order. Starts a job."""
    return report_differences(first, second, key).isEmpty()


def surplus_rows(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of the first frame beyond their copies in the second, copies kept.

    After the comparison there is one row for all copies. Rows with many leave in parts of
    ``COPIES``, dealt out before they are repeated, so no task writes a hot row's copies alone.
    """
    names = [F.col(f"`{n}`") for n in first.columns]
    more = row_differences(first, second).where(F.col("surplus") > 0)
    few = more.where(F.col("surplus") <= COPIES).select(*names, F.col("surplus").alias("_copies"))
    parts = F.sequence(F.lit(0), F.floor((F.col("surplus") - 1) / COPIES))
    many = more.where(F.col("surplus") > COPIES).withColumn("_part", F.explode(parts))
    size = F.least(F.lit(COPIES), F.col("surplus") - F.col("_part") * COPIES)
    tasks = int(first.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = many.withColumn("_copies", size).repartition(tasks, "_part", *names).select(*names, "_copies")
    one = F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")
    return few.unionByName(many).select(*names, one).drop("_copy")


def row_marks(frame: DataFrame) -> list[Column]:
    """Aggregates that two frames of equal rows share, in any order: a count and sums of hashes.

    Maps are hashed as sorted entries where a column is one.
    """
    parts = [
        F.array_sort(F.map_entries(F.col(f"`{f.name}`"))) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`")
        for f in frame.schema
    ]
    first, second = F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.sum(first.cast("decimal(20,0)")).alias("first_sum"),
        F.sum(second.cast("decimal(20,0)")).alias("second_sum"),
    ]


def _tagged(frame: DataFrame, side: str, key: str) -> DataFrame:
    return frame.select(key, F.lit(side).alias("_side"))
