"""Join queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import data
from millrace.catalog.data import with_sales
from millrace.operators import joins
from millrace.scratch import cut_lineage
from millrace.sources.tables import literal_rows

BANDS = [
    ("low", 0.0, 100000.0),
    ("middle", 100000.0, 250000.0),
    ("high", 250000.0, 450000.0),
    ("promoted", 200000.0, 300000.0),
]
BANDS_DDL = "band STRING, lower DOUBLE, upper DOUBLE"


def _sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.good_sales(spark, sf_dir).select("sale_id", "product_id", "amount")


def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sold(spark, sf_dir).join(data.wide_lookup(spark, sf_dir), on="product_id", how="inner")


def join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sold(spark, sf_dir).join(data.wide_lookup(spark, sf_dir), on="product_id", how="left")


def join_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Salted: AQE splits only the right side of a right join, and sales are on the left."""
    return joins.salted_join(
        _sold(spark, sf_dir), data.wide_lookup(spark, sf_dir), "product_id", "right"
    )


def join_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Salted: AQE does not split a skewed partition of a full join."""
    return joins.salted_join(
        _sold(spark, sf_dir), data.wide_lookup(spark, sf_dir), "product_id", "full"
    )


def join_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.matched(_sold(spark, sf_dir), data.doubled_lookup(spark, sf_dir), "product_id")


def join_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over all cleaned sales, so null keys are among the unmatched."""
    keys = data.cleaned(spark, sf_dir).select("sale_id", "product_id")
    return joins.unmatched(keys, data.lookup(spark, sf_dir), "product_id")


def join_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer with every one of three listed channels."""
    customers = data.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return joins.pair_with_values(customers, "channel", ["letter", "phone", "visit"], "string")


def join_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices outside all bands keep one row, prices in two bands get two."""
    orders = data.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    bands = literal_rows(spark, BANDS, BANDS_DDL)
    return joins.band_join(orders, bands, "o_totalprice").drop("lower", "upper")


def join_band_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken for many bands: events inside hours with more purchases than clicks."""
    events = data.table(spark, sf_dir, "events").select(
        "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "event_type", "ts"
    )
    hours = events.groupBy(F.window("ts", "1 hour").alias("hour")).agg(
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        F.count_if(F.col("event_type") == "click").alias("clicks"),
    )
    bands = hours.where(F.col("purchases") > F.col("clicks")).select(
        F.unix_micros(F.col("hour.start").cast("timestamp")).alias("lower"),
        F.unix_micros(F.col("hour.end").cast("timestamp")).alias("upper"),
        F.col("purchases").cast("double"),
    )
    rows = events.select("event_id", "at")
    stored = cut_lineage(bands, "busy-hours")
    return joins.band_join(rows, stored, "at", loop_rows=0).drop("lower", "upper")


def join_band_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items whose quantity lies below the part's size, others without a part."""
    items = data.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    sizes = data.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.lit(1.0).alias("lower"),
        F.col("p_size").cast("double").alias("upper"),
    )
    return joins.keyed_range_join(items, sizes, "l_partkey", "l_quantity", "lower", "upper")


def join_effective(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = data.versioned_lookup(spark, sf_dir).drop("is_current")
    good = data.good_sales(spark, sf_dir)
    return joins.version_at(good, versions, "product_id", "sold_at").drop("valid_from", "valid_to")


def join_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = data.versioned_lookup(spark, sf_dir).select("product_id", "category", "is_current")
    return joins.enrich(data.good_sales(spark, sf_dir), joins.current_versions(versions))


def join_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.fan_out(data.good_sales(spark, sf_dir), data.doubled_lookup(spark, sf_dir))


def join_fanout_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The multiplied rows themselves."""
    return _sold(spark, sf_dir).join(data.doubled_lookup(spark, sf_dir), "product_id", "left")


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type"
    )


def join_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.broadcast_join(_items(spark, sf_dir), _parts(spark, sf_dir), "l_partkey", "left")


def join_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.strategy_join(
        _items(spark, sf_dir), _parts(spark, sf_dir), "l_partkey", "left", "merge"
    )


def join_shuffle_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.strategy_join(
        _items(spark, sf_dir), _parts(spark, sf_dir), "l_partkey", "left", "shuffle_hash"
    )


def join_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.salted_join(_sold(spark, sf_dir), data.wide_lookup(spark, sf_dir), "product_id")


def hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types that hold more than a fifth of the events each."""
    return joins.hot_keys(data.table(spark, sf_dir, "events"), "event_type", 0.2)


QUERIES = {
    "join_inner": join_inner,
    "join_left": join_left,
    "join_right": join_right,
    "join_full": join_full,
    "join_semi": join_semi,
    "join_anti": join_anti,
    "join_listed": join_listed,
    "join_band": join_band,
    "join_band_binned": join_band_binned,
    "join_band_keyed": join_band_keyed,
    "join_effective": join_effective,
    "join_current": join_current,
    "join_fanout": join_fanout,
    "join_fanout_rows": join_fanout_rows,
    "join_broadcast": join_broadcast,
    "join_merge": join_merge,
    "join_shuffle_hash": join_shuffle_hash,
    "join_salted": join_salted,
    "hot_keys": hot_keys,
}


def _sales_join(kind: str) -> str:
    return with_sales(
        f"""SELECT coalesce(g.product_id, l.product_id) AS product_id, sale_id,
  CAST(amount AS DOUBLE) AS amount, category
FROM good g {kind} JOIN wide l ON g.product_id = l.product_id"""
    )


_PARTS_SQL = """SELECT l_partkey, l_orderkey, l_linenumber, p_brand, p_type
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey"""

SQL = {
    "join_inner": _sales_join("INNER"),
    "join_left": _sales_join("LEFT"),
    "join_right": _sales_join("RIGHT"),
    "join_full": _sales_join("FULL"),
    "join_semi": with_sales(
        """SELECT product_id, sale_id, CAST(amount AS DOUBLE) AS amount FROM good
WHERE product_id IN (SELECT product_id FROM lookup)"""
    ),
    "join_anti": with_sales(
        """SELECT product_id, sale_id FROM cleaned c
WHERE NOT EXISTS (SELECT 1 FROM lookup l WHERE l.product_id = c.product_id)"""
    ),
    "join_listed": """SELECT c_custkey, c_mktsegment, channel
FROM customer, (VALUES ('letter'), ('phone'), ('visit')) AS v(channel)""",
    "join_band": f"""SELECT o_orderkey, o_totalprice, band FROM orders
LEFT JOIN (VALUES {", ".join(f"('{n}', {a}, {b})" for n, a, b in BANDS)}) AS v(band, lower, upper)
ON o_totalprice >= lower AND o_totalprice < upper""",
    "join_band_binned": """WITH hours AS (
  SELECT time_bucket(INTERVAL 1 HOUR, ts) AS h,
    count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
    count(*) FILTER (WHERE event_type = 'click') AS clicks FROM events GROUP BY 1)
SELECT event_id, epoch_us(ts) AS at, CAST(purchases AS DOUBLE) AS purchases FROM events
LEFT JOIN hours ON ts >= h AND ts < h + INTERVAL 1 HOUR AND purchases > clicks""",
    "join_band_keyed": """SELECT l_orderkey, l_partkey, l_quantity,
  CASE WHEN p_partkey IS NOT NULL THEN CAST(1 AS DOUBLE) END AS lower,
  CAST(p_size AS DOUBLE) AS upper
FROM lineitem LEFT JOIN part
ON l_partkey = p_partkey AND l_quantity >= 1 AND l_quantity < p_size""",
    "join_effective": with_sales(
        """, versions AS (
  SELECT product_id, 'former' AS category, TIMESTAMP '1990-01-01 00:00:00' AS valid_from,
    TIMESTAMP '1998-07-01 00:00:00' AS valid_to FROM lookup
  UNION ALL
  SELECT product_id, category, TIMESTAMP '1998-07-01 00:00:00', NULL FROM lookup)
SELECT sale_id, g.product_id, CAST(amount AS DOUBLE) AS amount, sold_at, category
FROM good g LEFT JOIN versions v ON g.product_id = v.product_id
  AND sold_at >= valid_from AND (valid_to IS NULL OR sold_at < valid_to)"""
    ),
    "join_current": with_sales(
        """SELECT sale_id, product_id, CAST(amount AS DOUBLE) AS amount, sold_at, category
FROM enriched"""
    ),
    "join_fanout": with_sales(
        """SELECT (SELECT count(*) FROM good) AS rows_before, count(*) AS rows_after,
  (SELECT CAST(sum(amount) AS DOUBLE) FROM good) AS total_before,
  CAST(sum(amount) AS DOUBLE) AS total_after,
  count(DISTINCT g.product_id) FILTER (WHERE category = 'building') AS multiplied_keys
FROM good g LEFT JOIN doubled d ON g.product_id = d.product_id"""
    ),
    "join_fanout_rows": with_sales(
        """SELECT g.product_id, sale_id, CAST(amount AS DOUBLE) AS amount, category
FROM good g LEFT JOIN doubled d ON g.product_id = d.product_id"""
    ),
    "join_broadcast": _PARTS_SQL,
    "join_merge": _PARTS_SQL,
    "join_shuffle_hash": _PARTS_SQL,
    "join_salted": _sales_join("LEFT"),
    "hot_keys": """SELECT event_type FROM events GROUP BY event_type
HAVING count(*) > 0.2 * (SELECT count(*) FROM events)""",
}
