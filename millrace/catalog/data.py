"""The tables the registered queries read, and the messy sales derived from them.

Every order becomes one attempted sale; some keys, amounts and times are spoilt depending on the
order's own columns. Customers in credit form the lookup, so sales of the others stay unmapped.
``SALES_SQL`` states the same derivation for the SQL check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.cleaning import accepted, clean_lookup, clean_sales
from millrace.scratch import fresh_folder
from millrace.sinks.files import publish_arrival

RAW_SALES_DDL = "sale_id STRING, product_id STRING, amount_raw STRING, sold_at_raw STRING"
RAW_LOOKUP_DDL = "product_id STRING, category STRING"
ARRIVAL_CUTS = ("1997-01-01", "1999-01-01")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_sales(orders: DataFrame) -> DataFrame:
    priority, state = F.col("o_orderpriority"), F.col("o_orderstatus")
    customer, placed = F.col("o_custkey").cast("string"), F.col("o_orderdate")
    amount = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    day = F.dayofmonth(placed)
    return orders.select(
        F.concat(F.lit("s"), F.col("o_orderkey").cast("string")).alias("sale_id"),
        F.when(day == 31, F.lit(" "))
        .when(day == 30, F.lit(None))
        .when(priority == "5-LOW", F.concat(F.lit("  c"), customer, F.lit(" ")))
        .otherwise(F.concat(F.lit("C"), customer))
        .alias("product_id"),
        F.when((state == "P") & (priority == "1-URGENT"), F.lit("unreadable"))
        .when((state == "P") & (priority == "2-HIGH"), F.lit(None))
        .when(state == "O", F.concat(F.lit(" "), amount, F.lit(" ")))
        .otherwise(amount)
        .alias("amount_raw"),
        F.when((state == "F") & (priority == "3-MEDIUM"), F.lit("1999-02-30 08:00:00"))
        .when((state == "F") & (priority == "4-NOT SPECIFIED"), F.lit(None))
        .otherwise(F.date_format(placed.cast("timestamp"), "yyyy-MM-dd HH:mm:ss"))
        .alias("sold_at_raw"),
    )


def raw_lookup(customer: DataFrame) -> DataFrame:
    return customer.where(F.col("c_acctbal") >= 0).select(
        F.concat(F.lit(" c"), F.col("c_custkey").cast("string")).alias("product_id"),
        F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit("  ")).alias("category"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_sales(table(spark, sf_dir, "orders"))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_sales(sales(spark, sf_dir))


def good_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(cleaned(spark, sf_dir)).select("sale_id", "product_id", "amount", "sold_at")


def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_lookup(raw_lookup(table(spark, sf_dir, "customer")))


def wide_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers; those not in credit are prospects, under keys that no sale carries."""
    in_credit = F.col("c_acctbal") >= 0
    return table(spark, sf_dir, "customer").select(
        F.concat(F.when(in_credit, "C").otherwise("X"), F.col("c_custkey").cast("string")).alias(
            "product_id"
        ),
        F.when(in_credit, F.lower("c_mktsegment")).otherwise("prospect").alias("category"),
    )


def doubled_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup with one category delivered twice: what a careless union leaves behind."""
    once = lookup(spark, sf_dir)
    return once.unionByName(once.where(F.col("category") == "building"))


def versioned_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions per customer: ``former`` until the middle of 1998, its segment from then on."""
    once = lookup(spark, sf_dir)
    change = F.lit("1998-07-01 00:00:00").cast("timestamp")
    nothing = F.lit(None).cast("timestamp")
    versions = F.array(
        F.struct(
            F.lit("former").alias("category"),
            F.lit(False).alias("is_current"),
            F.lit("1990-01-01 00:00:00").cast("timestamp").alias("valid_from"),
            change.alias("valid_to"),
        ),
        F.struct(
            F.col("category"),
            F.lit(True).alias("is_current"),
            change.alias("valid_from"),
            nothing.alias("valid_to"),
        ),
    )
    return once.select("product_id", F.inline(versions))


def sales_arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The raw sales in three slices by order date; those without one are in the last."""
    orders = table(spark, sf_dir, "orders")
    placed = F.col("o_orderdate")
    kind = orders.schema["o_orderdate"].dataType
    early, late = (F.lit(cut).cast(kind) for cut in ARRIVAL_CUTS)
    slices = [placed < early, (placed >= early) & (placed < late), (placed >= late) | placed.isNull()]
    return [raw_sales(orders.where(s)) for s in slices]


def event_arrivals(
    spark: SparkSession, sf_dir: str, late_minutes: int = 0
) -> list[DataFrame]:
    """All events in three slices of equal length in time, oldest first.

    Events without a time are in the last. With ``late_minutes`` an event is delivered up to so
    much later than it happened, depending on its id, so slices overlap in time.
    """
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    late = F.pmod("event_id", F.lit(late_minutes + 1)) * 60_000_000
    at: Column = F.unix_micros("ts") + F.coalesce(late, F.lit(0))
    ends = events.agg(F.min(at).alias("first"), F.max(at).alias("last")).first()
    first, last = ends["first"] or 0, ends["last"] or 0
    step = (last - first) // 3 + 1
    slices = [(at >= first + step * i) & (at < first + step * (i + 1)) for i in range(3)]
    return [events.where(part) for part in (*slices[:2], slices[2] | at.isNull())]


def land(spark: SparkSession, slices: list[DataFrame], purpose: str) -> str:
    """Publish all slices to a new landing folder and return it."""
    landing = fresh_folder(spark, purpose)
    for number, rows in enumerate(slices, 1):
        publish_arrival(rows, landing, f"{number:02d}")
    return landing


def comparable(frame: DataFrame) -> DataFrame:
    """The same values in types that Spark and the SQL engine hand over alike.

    Exact decimals become doubles, dates become midnight, zoned times become plain ones.
    """
    columns = []
    for field in frame.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double").alias(field.name)
        elif isinstance(field.dataType, (T.DateType, T.TimestampType)):
            column = column.cast("timestamp_ntz").alias(field.name)
        columns.append(column)
    return frame.select(*columns)


SALES_SQL = """
sales AS (
  SELECT 's' || CAST(o_orderkey AS VARCHAR) AS sale_id,
    CASE WHEN day(o_orderdate) = 31 THEN ' '
         WHEN day(o_orderdate) = 30 THEN NULL
         WHEN o_orderpriority = '5-LOW' THEN '  c' || CAST(o_custkey AS VARCHAR) || ' '
         ELSE 'C' || CAST(o_custkey AS VARCHAR) END AS product_id,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'unreadable'
         WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN NULL
         WHEN o_orderstatus = 'O'
         THEN ' ' || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) || ' '
         ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS amount_raw,
    CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM' THEN '1999-02-30 08:00:00'
         WHEN o_orderstatus = 'F' AND o_orderpriority = '4-NOT SPECIFIED' THEN NULL
         ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS sold_at_raw,
    o_orderdate AS placed
  FROM orders),
parsed AS (
  SELECT sale_id, upper(trim(product_id)) AS product_id, amount_raw, sold_at_raw, placed,
    TRY_CAST(amount_raw AS DECIMAL(12,2)) AS amount,
    TRY_STRPTIME(sold_at_raw, '%Y-%m-%d %H:%M:%S') AS sold_at
  FROM sales),
cleaned AS (
  SELECT *, CASE WHEN product_id IS NULL OR product_id = '' THEN 'missing product key'
                 WHEN amount IS NULL THEN 'invalid or missing amount'
                 WHEN sold_at IS NULL THEN 'invalid or missing timestamp' END AS reject_reason
  FROM parsed),
good AS (SELECT sale_id, product_id, amount, sold_at, placed FROM cleaned
         WHERE reject_reason IS NULL),
lookup AS (
  SELECT 'C' || CAST(c_custkey AS VARCHAR) AS product_id, lower(c_mktsegment) AS category
  FROM customer WHERE c_acctbal >= 0),
wide AS (
  SELECT CASE WHEN c_acctbal >= 0 THEN 'C' ELSE 'X' END || CAST(c_custkey AS VARCHAR) AS product_id,
    CASE WHEN c_acctbal >= 0 THEN lower(c_mktsegment) ELSE 'prospect' END AS category
  FROM customer),
doubled AS (
  SELECT * FROM lookup UNION ALL SELECT * FROM lookup WHERE category = 'building'),
enriched AS (
  SELECT sale_id, g.product_id, amount, sold_at, coalesce(category, 'unmapped') AS category, placed
  FROM good g LEFT JOIN lookup l ON g.product_id = l.product_id)
"""


def with_sales(select: str) -> str:
    return f"WITH {SALES_SQL}\n{select}"
