"""Queries on stored layouts, mergeable counts, histories and running totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import data
from millrace.operators import distinct, history, running
from millrace.scratch import cut_lineage, fresh_folder
from millrace.sinks import layouts
from millrace.sinks.files import publish_arrival, write_once
from millrace.sinks.streams import to_files
from millrace.sources.streams import arrivals
from millrace.streaming import event_time
from millrace.streaming.runs import AVAILABLE_NOW, finish

BUCKETS = 16
SNAPSHOTS = ("1996-01-01", "1997-01-01", "1998-01-01")


def _new_table(spark: SparkSession, purpose: str) -> str:
    return fresh_folder(spark, purpose).rsplit("/", 1)[1].replace("-", "_")


def join_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items and parts stored in buckets of the part key, joined without a shuffle."""
    items = data.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = data.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    stored = [
        layouts.write_bucketed(frame, _new_table(spark, name), "l_partkey", BUCKETS)
        for name, frame in (("items", items), ("parts", parts))
    ]
    return layouts.bucketed_join(*stored, "l_partkey")


def periods_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales stored by month; those of one month are corrected and put back, then all are read."""
    sold = data.good_sales(spark, sf_dir)
    folder = layouts.write_by_period(sold, fresh_folder(spark, "by-month"), "sold_at")
    wrong = spark.read.parquet(folder).where(F.col("period") == F.lit("1997-03-01").cast("date"))
    raised = (F.col("amount") + 1).cast("decimal(12,2)")
    fixed = cut_lineage(wrong.drop("period").withColumn("amount", raised), "fixed")
    layouts.replace_periods(fixed, folder, "sold_at")
    return layouts.read_periods(spark, folder)


def distinct_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers per month out of stored daily bitmaps, not out of the orders."""
    orders = data.table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"))
    folder = write_once(distinct.id_bitmaps(orders, "o_custkey", "day"), fresh_folder(spark, "bitmaps"))
    daily = spark.read.parquet(folder).withColumn("month", F.date_trunc("month", "day"))
    return distinct.distinct_ids(daily, "month", label="customers")


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was known of each customer at three times: its newest order's priority and state so far."""
    orders = data.table(spark, sf_dir, "orders")
    taken = F.explode(F.array(*[F.lit(t).cast("timestamp") for t in SNAPSHOTS])).alias("taken")
    known = orders.select("*", taken).where(
        (F.col("o_orderdate") < F.col("taken")) & (F.col("o_orderdate") >= F.col("taken") - F.expr("INTERVAL 2 YEARS"))
    )
    newest = F.max_by(F.struct("o_orderpriority", "o_orderstatus"), F.struct("o_orderdate", "o_orderkey")).alias("last")
    return known.groupBy(F.col("o_custkey").alias("customer"), "taken").agg(newest).select(
        "customer", "taken", F.col("last.o_orderpriority").alias("priority"), F.col("last.o_orderstatus").alias("state")
    )


def version_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.versions(snapshots(spark, sf_dir), "customer", "taken")


def running_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sale with its place in time and the total so far."""
    sold = data.good_sales(spark, sf_dir).select("sold_at", "sale_id", "amount")
    return running.running_totals(sold, "sold_at", "sale_id", measure="amount")


def sales_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third page of fifty sales in order of amount."""
    sold = data.good_sales(spark, sf_dir).select("amount", "sale_id")
    return running.page(running.running_totals(sold, "amount", "sale_id"), 3, 50)


def win_daily_maxima(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts and, chained in the same query, the busiest hour's count of each day."""
    landing, output = fresh_folder(spark, "events"), fresh_folder(spark, "maxima")
    checkpoint = fresh_folder(spark, "checkpoint")
    schema = "event_id BIGINT, ts TIMESTAMP, event_type STRING"
    for number, rows in enumerate(data.event_arrivals(spark, sf_dir), 1):
        publish_arrival(rows, landing, f"{number:02d}")
        stream = event_time.watermarked(arrivals(spark, landing, schema), "ts", "2 hours")
        maxima = event_time.busiest(stream, "ts", "1 hour", "1 day", "event_type")
        finish(to_files(maxima, output, checkpoint, trigger=AVAILABLE_NOW))
    return spark.read.parquet(output)


QUERIES = {
    "join_bucketed": join_bucketed,
    "periods_replaced": periods_replaced,
    "distinct_rollup": distinct_rollup,
    "version_history": version_history,
    "running_sales": running_sales,
    "sales_page": sales_page,
    "win_daily_maxima": win_daily_maxima,
}

_TAKEN = ", ".join(f"(TIMESTAMP '{t}')" for t in SNAPSHOTS)
SQL = {
    "join_bucketed": """SELECT l_orderkey, l_linenumber, l_partkey, p_brand
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "periods_replaced": data.with_sales(
        """SELECT sale_id, product_id, sold_at, CAST(date_trunc('month', sold_at) AS TIMESTAMP) AS period,
  CAST(amount + CASE WHEN date_trunc('month', sold_at) = DATE '1997-03-01' THEN 1 ELSE 0 END AS DOUBLE) AS amount
FROM good"""
    ),
    "distinct_rollup": """SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month,
  count(DISTINCT o_custkey) AS customers FROM orders GROUP BY ALL""",
    "version_history": f"""WITH t(taken) AS (VALUES {_TAKEN}),
s AS (
  SELECT o_custkey AS customer, taken, max_by(o_orderpriority, (o_orderdate, o_orderkey)) AS priority,
    max_by(o_orderstatus, (o_orderdate, o_orderkey)) AS state
  FROM orders, t WHERE o_orderdate < taken AND o_orderdate >= taken - INTERVAL 2 YEAR GROUP BY ALL),
n AS (
  SELECT *, (SELECT min(taken) FROM t WHERE t.taken > s.taken) AS next_taken,
    coalesce(priority = lag(priority) OVER w AND state = lag(state) OVER w
      AND lag(taken) OVER w = (SELECT max(taken) FROM t WHERE t.taken < s.taken), false) AS same
  FROM s WINDOW w AS (PARTITION BY customer ORDER BY taken)),
v AS (SELECT *, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY customer ORDER BY taken) AS version FROM n)
SELECT customer, priority, state, min(taken) AS valid_from, max_by(coalesce(next_taken, TIMESTAMP '9999-01-01'), taken) AS valid_to
FROM v GROUP BY customer, version, priority, state""",
    "running_sales": data.with_sales(
        """SELECT sold_at, sale_id, CAST(amount AS DOUBLE) AS amount,
  row_number() OVER (ORDER BY sold_at, sale_id) AS position,
  CAST(sum(amount) OVER (ORDER BY sold_at, sale_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total
FROM good"""
    ),
    "sales_page": data.with_sales(
        """SELECT CAST(amount AS DOUBLE) AS amount, sale_id, position FROM (
  SELECT amount, sale_id, row_number() OVER (ORDER BY amount, sale_id) AS position FROM good)
WHERE position BETWEEN 101 AND 150"""
    ),
    "win_daily_maxima": """WITH h AS (
  SELECT time_bucket(INTERVAL 1 HOUR, ts) AS hour, event_type, count(*) AS events FROM events GROUP BY ALL)
SELECT day AS window_start, day + INTERVAL 1 DAY AS window_end, event_type, max(events) AS busiest, count(*) AS parts
FROM (SELECT CAST(date_trunc('day', hour) AS TIMESTAMP) AS day, event_type, events FROM h)
WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events) GROUP BY day, event_type""",
}
SQL["version_history"] = f"""SELECT customer, priority, state, valid_from,
  nullif(valid_to, TIMESTAMP '9999-01-01') AS valid_to, valid_to = TIMESTAMP '9999-01-01' AS is_current
FROM ({SQL["version_history"]})"""
