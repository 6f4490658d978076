"""Joins: lookups, strategies, ranges, versions and skew.

Plain joins carry no hint: Spark broadcasts a side it has measured to be small and AQE splits
skewed partitions. Functions marked "starts a job" measure a side before they decide.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.expressions import or_else
from millrace.functions.fixed import UNMAPPED
from millrace.scratch import cut_lineage

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
BAND_LOOP_ROWS = 256
MAX_LISTED_VALUES = 1_000
HOT_SHARE = 0.02
LEAST_SHARE = 1e-5
SALTS = 32


def _named(name: str) -> Column:
    return F.col(f"`{name}`")


# --- lookups -------------------------------------------------------------------------------------


def enrich(
    rows: DataFrame,
    lookup: DataFrame,
    on: str = "product_id",
    label: str = "category",
    keep: Sequence[str] = ("sale_id", "product_id", "amount", "sold_at"),
    fallback: str = UNMAPPED,
) -> DataFrame:
    """Add the lookup's label to every row; rows without a match get the fallback label.

    The lookup must hold one row per key (``quality.lookup_problems`` tells), or rows multiply.
    Works on a stream joined with a static lookup.
    """
    joined = rows.join(lookup.select(on, label), on=on, how="left")
    return joined.select(*keep, or_else(F.col(label), fallback).alias(label))


def totals_through_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    on: str = "product_id",
    label: str = "category",
    measure: str = "amount",
    fallback: str = UNMAPPED,
) -> DataFrame:
    """The same report as ``totals_by(enrich(...), label)``, summed per key before the join.

    Rows shrink to one per key on the map side, so a key that holds a third of all rows reaches
    the join as one row, and the shuffle carries keys instead of sales. Duplicate lookup keys
    multiply counts and sums exactly as they would multiply rows.
    """
    per_key = rows.groupBy(on).agg(F.count(F.lit(1)).alias("sales"), F.sum(measure).alias("total"))
    total_type = per_key.schema["total"].dataType
    joined = per_key.join(lookup.select(on, label), on=on, how="left")
    return joined.groupBy(or_else(F.col(label), fallback).alias(label)).agg(
        F.sum("sales").alias("sales"), F.sum("total").cast(total_type).alias("total")
    )


def matched(rows: DataFrame, lookup: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key the lookup holds: left columns only, never multiplied."""
    return rows.join(lookup, on=on, how="left_semi")


def unmatched(rows: DataFrame, lookup: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key the lookup lacks; a null key is unmatched and stays (unlike NOT IN)."""
    return rows.join(lookup, on=on, how="left_anti")


def fan_out(
    rows: DataFrame, lookup: DataFrame, on: str = "product_id", measure: str = "amount"
) -> DataFrame:
    """One row: what a left join with this lookup does to the row count and the total.

    Counted per key on both sides, so nothing is multiplied to find out.
    """
    per_key = rows.groupBy(on).agg(F.count(F.lit(1)).alias("_n"), F.sum(measure).alias("_total"))
    copies = lookup.groupBy(on).agg(F.count(F.lit(1)).alias("_copies"))
    times = F.coalesce("_copies", F.lit(1))
    return per_key.join(copies, on, "left").agg(
        F.sum("_n").alias("rows_before"),
        F.sum(F.col("_n") * times).alias("rows_after"),
        F.sum("_total").alias("total_before"),
        F.sum(F.col("_total") * times).alias("total_after"),
        F.count_if(times > 1).alias("multiplied_keys"),
    )


# --- strategies ----------------------------------------------------------------------------------


def fits_broadcast(
    side: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether a side is small enough to copy to every executor.

    Starts a job, which looks at no more rows than decide it.
    """
    width = sum(
        (F.coalesce(F.octet_length(_named(c).cast("string")), F.lit(0)) + 8 for c in side.columns),
        F.lit(0),
    )
    size = side.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum(width), F.lit(0)).alias("byte_count")
    ).first()
    return size["row_count"] <= max_rows and size["byte_count"] <= max_bytes


def broadcast_join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Copy the right side to every executor if it measures small, else join by shuffle.

    The rows are the same either way. Starts a job.
    """
    if how not in {"inner", "left", "left_semi", "left_anti"}:
        raise ValueError(f"a {how} join cannot broadcast its right side")
    if fits_broadcast(right, max_rows, max_bytes):
        return left.join(F.broadcast(right), on=on, how=how)
    return left.join(right, on=on, how=how)


def strategy_join(
    left: DataFrame, right: DataFrame, on: str | list[str], how: str, strategy: str
) -> DataFrame:
    """Ask for ``merge`` (sort-merge, spills) or ``shuffle_hash`` (hash table per partition).

    For ``shuffle_hash`` a partition of the right side must fit in a task's memory: give it the
    side with few rows per key.
    """
    if strategy not in {"merge", "shuffle_hash"}:
        raise ValueError(f"unknown strategy {strategy!r}; for broadcast use broadcast_join")
    return left.join(right.hint(strategy), on=on, how=how)


def pair_with_values(
    frame: DataFrame, name: str, values: Sequence, ddl_type: str, max_values: int = MAX_LISTED_VALUES
) -> DataFrame:
    """Every row with every listed value: n x m rows, where m is a short list in the plan.

    This is the bounded form of a cross join; there is no join in it, so nothing is copied or
    compared. Give it a handful of labels, not data: more than ``max_values`` are refused.
    """
    if len(values) > max_values:
        raise ValueError(f"{len(values)} values; at most {max_values} may be listed")
    listed = F.array(*[F.lit(v).cast(ddl_type) for v in values])
    return frame.withColumn(name, F.explode(listed))


# --- ranges and versions -------------------------------------------------------------------------


def band_join(
    rows: DataFrame,
    bands: DataFrame,
    value: str,
    lower: str = "lower",
    upper: str = "upper",
    how: str = "left",
    loop_rows: int = BAND_LOOP_ROWS,
) -> DataFrame:
    """Rows with every band for which ``lower <= value < upper``: numbers, dates or timestamps.

    Few bands are broadcast and tested one by one, which leaves the rows where they are. Beyond
    ``loop_rows`` bands are put into classes by width: a class has bins of the next power of two,
    so a band of any width, an endless one included, lies in two or three bins of its class, and
    wide bands do not crowd the narrow ones' bins. A row has one bin in each class there is. The
    range itself stays a residual test, and crowded bins are spread. With several classes, a left
    join adds the rows whose value no band holds, found from the distinct values.

    Starts jobs: bands are measured, their classes listed (powers of two, so at most some
    hundreds), crowded bins searched for.
    """
    if how not in {"inner", "left"}:
        raise ValueError("how must be inner or left")
    inside = (_named(value) >= _named(lower)) & (_named(value) < _named(upper))
    if fits_broadcast(bands, max_rows=loop_rows):
        return rows.join(F.broadcast(bands), inside, how)
    real = bands.where(_named(lower) < _named(upper))
    low, high = (_as_number(real, c) for c in (lower, upper))
    width = F.greatest(high - low, F.lit(2.0**-1000))
    real = real.withColumn("_class", F.least(F.ceil(F.log2(width)), F.lit(1023)).cast("int"))
    classes = sorted(row["_class"] for row in real.select("_class").distinct().collect())
    first, last = (_bin_of(c, F.col("_class")) for c in (low, high))
    binned = real.withColumn("_bin", F.explode(F.sequence(first, last)))

    def in_classes(frame: DataFrame) -> DataFrame:
        listed = F.array(*[F.lit(c) for c in classes]) if classes else F.lit(None).cast("array<int>")
        spread = frame.withColumn("_class", F.explode_outer(listed))
        return spread.withColumn("_bin", _bin_of(_as_number(frame, value), F.col("_class")))

    on = ["_class", "_bin"]
    if how == "inner" or len(classes) <= 1:
        return salted_join(in_classes(rows), binned, on, how, residual=inside).drop(*on)
    met = salted_join(in_classes(rows), binned, on, "inner", residual=inside).drop(*on)
    values = in_classes(rows.select(_named(value)).distinct())
    held = salted_join(values, binned, on, "left_semi", residual=inside).select(_named(value))
    alone = rows.join(held.distinct().withColumnRenamed(value, "_held"), _named(value) == F.col("_held"), "left_anti")
    return met.unionByName(alone, allowMissingColumns=True)


def _as_number(frame: DataFrame, name: str) -> Column:
    """A number that grows with the column: days, microseconds, or the value, kept finite."""
    kind = frame.schema[name].dataType
    if isinstance(kind, T.DateType):
        number = F.unix_date(_named(name))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        number = F.unix_micros(_named(name).cast("timestamp"))
    else:
        number = _named(name)
    most = F.lit(8.9e307)  # so that widths stay finite too
    return F.greatest(-most, F.least(most, number.cast("double")))


def _bin_of(number: Column, class_: Column) -> Column:
    """The bin of a number among bins as wide as two to the power of its class."""
    bin_ = F.floor(number / F.pow(F.lit(2.0), class_.cast("double")))
    # Bins beyond 2**62 are one: numbers that large, beside bands that narrow, have no fractions.
    most = F.lit(float(2**62))
    return F.greatest(-most, F.least(most, bin_.cast("double"))).cast("bigint")


def keyed_range_join(
    rows: DataFrame,
    ranges: DataFrame,
    on: str | list[str],
    value: str,
    lower: str,
    upper: str,
    how: str = "left",
) -> DataFrame:
    """Equal keys and ``lower <= value < upper``: the key drives the join, the range filters it."""
    keys = [on] if isinstance(on, str) else list(on)
    renamed = ranges.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    inside = (F.col(value) >= F.col(lower)) & (F.col(value) < F.col(upper))
    return rows.join(renamed, _equal(keys) & inside, how).drop(*[f"_right_{k}" for k in keys])


def version_at(
    rows: DataFrame,
    versions: DataFrame,
    on: str | list[str],
    at: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> DataFrame:
    """Each row with the lookup version in force at its own time; an open end never expires."""
    keys = [on] if isinstance(on, str) else list(on)
    renamed = versions.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    in_force = (F.col(at) >= F.col(valid_from)) & (
        F.col(valid_to).isNull() | (F.col(at) < F.col(valid_to))
    )
    return rows.join(renamed, _equal(keys) & in_force, "left").drop(*[f"_right_{k}" for k in keys])


def current_versions(versions: DataFrame, flag: str = "is_current") -> DataFrame:
    """Only the rows marked current, without the mark: one row per key again."""
    return versions.where(F.col(flag)).drop(flag)


# --- skew ----------------------------------------------------------------------------------------


def hot_keys(rows: DataFrame, on: str | list[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys that hold more than ``share`` of the rows, a null key included; fewer than 1 / share.

    Starts a job: a frequent-items sketch of the keys, merged on the map side, so no key is
    shuffled. It misses no key above seven in ``tracked`` of the rows, which is below ``share``,
    and what it finds is then counted exactly.
    """
    keys = [on] if isinstance(on, str) else list(on)
    found, total = heavy_digests(rows, keys, share)
    digest = key_digest(rows, keys)
    counted = rows.where(digest.isin([d for d, _ in found]))
    counted = counted.groupBy(*[_named(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    return counted.where(F.col("_n") > F.lit(total * share)).select(*[_named(k) for k in keys])


def key_digest(rows: DataFrame, keys: Sequence[str], kinds: Sequence[T.DataType] | None = None) -> Column:
    """A hash that equal keys share, computed in ``kinds`` where sides differ in type."""
    kinds = kinds or [rows.schema[k].dataType for k in keys]
    parts = []
    for key, kind in zip(keys, kinds, strict=True):
        part = _named(key) if rows.schema[key].dataType == kind else _named(key).cast(kind)
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            part = part + F.lit(0).cast(kind)  # the two zeros are equal keys
        parts.append(part)
    return F.xxhash64(*parts)


def heavy_digests(
    rows: DataFrame, keys: Sequence[str], share: float, digest: Column | None = None
) -> tuple[list[tuple[int, int]], int]:
    """Digests of keys above ``share`` of the rows, each with its count, and the count of all rows.

    Starts a job: one pass, a mergeable sketch. Counts are the sketch's, never below the truth.
    """
    if not LEAST_SHARE <= share < 1:
        raise ValueError("share must be at least 0.00001 and below 1")
    listed, tracked = math.ceil(2 / share), max(10_000, math.ceil(8 / share))
    digest = key_digest(rows, keys) if digest is None else digest
    sketch = (
        rows.select(digest.alias("_digest"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.expr(f"approx_top_k(_digest, {listed}, {tracked})").alias("top"),
        )
        .first()
    )
    total = sketch["row_count"]
    found = [(e["item"], e["count"]) for e in sketch["top"] or () if e["count"] > total * share]
    return found, total


def fair_share(frame: DataFrame) -> float:
    """What one shuffle partition would hold of rows spread evenly."""
    partitions = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(0.5, max(LEAST_SHARE, 1 / max(1, partitions)))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    how: str = "left",
    salts: int = SALTS,
    share: float | None = None,
    residual: Column | None = None,
    hot: Sequence[tuple] | None = None,
) -> DataFrame:
    """Join as usual, but spread the left side's hot keys over several partitions each.

    A key is hot above ``share`` of the left rows, by default what a shuffle partition would hold
    of rows spread evenly, and gets a salt for each such share it has (rounded up to a power of
    two). Only right rows of hot keys are repeated, once per salt. Keys named as ``hot`` are not
    searched for and get ``salts`` each; naming a key that does not occur changes nothing. The
    salt comes from the row and its input partition, so a retried task gives a row the same salt
    and copies of one row still spread.

    The left side is evaluated twice, once to find the hot keys: by a sketch, or, for a right or
    full join, by counts per key stored in the shared folder, which also tell the right rows
    without a partner. ``residual`` may test further columns of both sides by name; apart from
    the keys, the sides must not share column names.
    """
    keys = [on] if isinstance(on, str) else list(on)
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    if clash and how not in {"left_semi", "left_anti"}:
        raise ValueError(f"both sides have {sorted(clash)}; rename one side first")
    if how not in {"inner", "left", "right", "full", "left_semi", "left_anti"}:
        raise ValueError(f"unknown join type {how!r}")
    if residual is not None and how in {"right", "full"}:
        raise ValueError(f"a {how} join takes no residual condition")

    share = fair_share(left) if share is None else share
    kinds = [_common_type(left, right, k) for k in keys]
    digest = key_digest(left, keys, kinds)
    present = None
    if how in {"right", "full"}:
        counts = left.groupBy(*[_named(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
        present = cut_lineage(counts, "key-counts")
    if hot is not None:
        spread = {d: salts for d in _digests_of(left, keys, kinds, hot)}
    elif present is not None:
        total = present.agg(F.sum("_n")).first()[0] or 0
        heavy = present.where(F.col("_n") > F.lit(total * share))
        rows = heavy.select(digest.alias("_digest"), "_n").collect()
        spread = {r["_digest"]: _power_of_two(r["_n"] / (total * share)) for r in rows}
    else:
        found, total = heavy_digests(left, keys, share, digest)
        spread = {d: _power_of_two(n / (total * share)) for d, n in found}

    rest = [_named(c) for c in left.columns if c not in keys]
    added = [_named(c) for c in right.columns if c not in keys]
    matching = {"right": "inner", "full": "left"}.get(how, how)
    salted, repeated = left, right
    if spread:
        slot = F.xxhash64(*_hashable(left), F.spark_partition_id())
        salted = left.withColumn("_salt", F.pmod(slot, _salts(spread, digest)).cast("int"))
        known = reduce(and_, [_named(k).isNotNull() for k in keys])  # a null key matches nothing
        copies = F.when(known, _salts(spread, key_digest(right, keys, kinds))).otherwise(1)
        repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), copies - 1)))
    together = [*keys, "_salt"] if spread else keys
    repeated = repeated.withColumnsRenamed({k: f"_right_{k}" for k in together})
    condition = _equal(together)
    if residual is not None:
        condition = condition & residual
    joined = salted.join(repeated, condition, matching)
    if how in {"left_semi", "left_anti"}:
        return joined.select(*[_named(k) for k in keys], *rest)
    if present is None:
        return joined.select(*[_named(k) for k in keys], *rest, *added)
    # Keys as the widest of both types, like those of the right rows that have no partner.
    named = [_named(k).cast(kind).alias(k) for k, kind in zip(keys, kinds, strict=True)]
    others = present.select(*[_named(k).alias(f"_right_{k}") for k in keys])
    alone = right.join(others, _equal(keys), "left_anti")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema if f.name not in keys]
    return joined.select(*named, *rest, *added).union(alone.select(*named, *nothing, *added))


def _power_of_two(at_least: float) -> int:
    return 1 << max(0, math.ceil(math.log2(max(1.0, at_least))))


def _salts(spread: dict[int, int], digest: Column) -> Column:
    """The number of salts of a key, by its digest: a set lookup for each number there is."""
    out = F.lit(1)
    for n in sorted(set(spread.values()) - {1}):
        out = F.when(digest.isin([d for d, m in spread.items() if m == n]), n).otherwise(out)
    return out


def _digests_of(
    frame: DataFrame, keys: Sequence[str], kinds: Sequence[T.DataType], values: Sequence[tuple]
) -> list[int]:
    if not values:
        return []
    fields = [T.StructField(k, frame.schema[k].dataType) for k in keys]
    named = frame.sparkSession.createDataFrame([tuple(v) for v in values], T.StructType(fields))
    return [row[0] for row in named.select(key_digest(named, keys, kinds)).collect()]


def _common_type(left: DataFrame, right: DataFrame, key: str) -> T.DataType:
    """The type in which two key columns are compared."""
    one, other = left.schema[key].dataType, right.schema[key].dataType
    if one == other:
        return one
    both = F.coalesce(F.lit(None).cast(one), F.lit(None).cast(other)).alias("key")
    return left.sparkSession.range(0).select(both).schema["key"].dataType


def _hashable(frame: DataFrame) -> list[Column]:
    return [_named(f.name) for f in frame.schema if "map<" not in f.dataType.simpleString()]


def _equal(names: Sequence[str]) -> Column:
    return reduce(and_, [_named(n) == _named(f"_right_{n}") for n in names])
