"""Queries on unreadable, repeated and missing rows: what was delivered, counted and remembered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import data
from millrace.catalog.data import with_sales
from millrace.operators.cleaning import accepted, clean_sales, explain_malformed, rejected
from millrace.operators.reports import category_totals
from millrace.scratch import fresh_folder
from millrace.sinks import streams as sinks
from millrace.sinks.files import publish_arrival, write_with_audit
from millrace.sources.streams import arrivals, record_arrivals
from millrace.sources.tables import read_records
from millrace.streaming import dedup, event_time, metrics, silence, state
from millrace.streaming.lookups import enrich_stream
from millrace.streaming.runs import AVAILABLE_NOW, finish

RECORDS_DDL = "order_key BIGINT, customer BIGINT, price DECIMAL(12,2), placed DATE"
WATERMARK = "2 hours"
SILENCE_SECONDS = 12 * 3600
_JSON = '{"order_key":%s,"customer":%s,"price":%s,"placed":"%s"}'


def _fields(orders: DataFrame) -> dict[str, Column]:
    price = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    return {
        "key": F.col("o_orderkey").cast("string"),
        "customer": F.col("o_custkey").cast("string"),
        "price": price,
        "placed": F.date_format("o_orderdate", "yyyy-MM-dd"),
    }


def csv_lines(orders: DataFrame) -> DataFrame:
    """Orders as lines of CSV; half of them are spoilt in one of five ways, by their keys."""
    f, case = _fields(orders), F.col("o_orderkey") % 10
    line = (
        F.when(case == 1, F.concat_ws(",", f["key"], f["customer"]))
        .when(case == 2, F.concat_ws(",", *f.values(), F.lit("more")))
        .when(case == 3, F.concat_ws(",", f["key"], f["customer"], F.lit("n/a"), f["placed"]))
        .when(case == 4, F.concat_ws(",", f["key"], f["customer"], f["price"], F.lit("1999-02-30")))
        .when(case == 5, F.concat_ws(",", F.concat(F.lit("no "), f["key"]), f["customer"], f["price"], f["placed"]))
        .otherwise(F.concat_ws(",", *f.values()))
    )
    return orders.select(line.alias("value"))


def json_lines(orders: DataFrame) -> DataFrame:
    """Orders as lines of JSON; some are cut off or hold a text for a number."""
    f, case = _fields(orders), F.col("o_orderkey") % 10
    price = F.when(case == 3, F.lit('"n/a"')).otherwise(f["price"])
    line = F.format_string(_JSON, f["key"], f["customer"], price, f["placed"])
    return orders.select(F.when(case == 1, F.substring(line, 1, 20)).otherwise(line).alias("value"))


def csv_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rows on one side, raw lines of what could not be read on the other, both stored."""
    folder, output = fresh_folder(spark, "lines"), fresh_folder(spark, "audit")
    csv_lines(data.table(spark, sf_dir, "orders")).write.text(folder)
    rows = explain_malformed(read_records(spark, folder, RECORDS_DDL))
    good, bad = write_with_audit(accepted(rows).drop("raw_line", "reject_reason"), rejected(rows), output)
    return spark.read.parquet(bad).unionByName(spark.read.parquet(good), allowMissingColumns=True)


def stream_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines in two arrivals; misfits leave the stream through the reject audit."""
    orders = data.table(spark, sf_dir, "orders")
    landing, output = fresh_folder(spark, "landing"), fresh_folder(spark, "split")
    checkpoint = fresh_folder(spark, "checkpoint")
    early = F.col("o_orderdate") < F.lit("1997-01-01").cast("date")
    for name, part in (("01", orders.where(early)), ("02", orders.where(~early))):
        json_lines(part).write.text(f"{landing}/{name}")
        rows = explain_malformed(record_arrivals(spark, landing, RECORDS_DDL, source="json"))
        finish(sinks.to_batches(rows, sinks.split_by_reason(output), checkpoint, trigger=AVAILABLE_NOW))
    return sinks.rejected_batches(spark, output).unionByName(
        sinks.accepted_batches(spark, output), allowMissingColumns=True
    )


def redelivered_events(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Events in three arrivals. A third of them come twice at once, others again with the next arrival."""
    slices, out, earlier = data.event_arrivals(spark, sf_dir), [], None
    for part in slices:
        rows = part.unionByName(part.where(F.col("event_id") % 3 == 0))
        if earlier is not None:
            rows = rows.unionByName(earlier.where(F.col("event_id") % 4 == 0))
        out.append(rows)
        earlier = part
    return out


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event once, whatever was delivered again; a run per arrival on one checkpoint."""
    landing, output = fresh_folder(spark, "events"), fresh_folder(spark, "once")
    checkpoint = fresh_folder(spark, "checkpoint")
    schema = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING"
    for number, rows in enumerate(redelivered_events(spark, sf_dir), 1):
        publish_arrival(rows, landing, f"{number:02d}")
        once = dedup.once_within(arrivals(spark, landing, schema), "ts", WATERMARK, "event_id")
        finish(sinks.to_files(once, output, checkpoint, trigger=AVAILABLE_NOW))
    return spark.read.parquet(output)


def _sold_report(spark: SparkSession, sf_dir: str, landing: str) -> DataFrame:
    raw = arrivals(spark, landing, data.RAW_SALES_DDL)
    return category_totals(enrich_stream(accepted(clean_sales(raw)), data.lookup(spark, sf_dir)))


def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a checkpoint holds after two of three arrivals, read when all three are in."""
    landing, output = fresh_folder(spark, "landing"), fresh_folder(spark, "report")
    checkpoint = fresh_folder(spark, "checkpoint")
    for number, rows in enumerate(data.sales_arrivals(spark, sf_dir), 1):
        publish_arrival(rows, landing, f"{number:02d}")
        report = _sold_report(spark, sf_dir, landing)
        finish(
            sinks.to_batches(report, sinks.batch_folder(output), checkpoint, "complete", AVAILABLE_NOW)
        )
    held = state.flat_state(state.state_rows(spark, checkpoint, batch=1))
    return held.select(
        "category", F.col("state_count").alias("sales"), F.col("state_sum").alias("total")
    )


def stream_silence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users not seen for over twelve hours; state and timers outlast a restart between arrivals."""
    landing, output = fresh_folder(spark, "events"), fresh_folder(spark, "alerts")
    checkpoint = fresh_folder(spark, "checkpoint")
    schema = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT"
    for number, rows in enumerate(data.event_arrivals(spark, sf_dir), 1):
        publish_arrival(rows, landing, f"{number:02d}")
        seen = event_time.watermarked(arrivals(spark, landing, schema), "ts", WATERMARK)
        alerts = silence.silence_alerts(seen, "user_id", "ts", SILENCE_SECONDS)
        finish(sinks.to_files(alerts, output, checkpoint, trigger=AVAILABLE_NOW))
    return spark.read.parquet(output)


def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input, accepted and rejected rows per arrival, as the running query counted them."""
    landing, output = fresh_folder(spark, "landing"), fresh_folder(spark, "cleaned")
    checkpoint, stored = fresh_folder(spark, "checkpoint"), fresh_folder(spark, "metrics")
    with metrics.BatchMetrics(spark) as kept:
        for number, rows in enumerate(data.sales_arrivals(spark, sf_dir), 1):
            publish_arrival(rows, landing, f"{number:02d}")
            parsed = clean_sales(arrivals(spark, landing, data.RAW_SALES_DDL))
            counted = metrics.observed(parsed, metrics.outcome_counts())
            query = finish(sinks.to_files(counted, output, checkpoint, trigger=AVAILABLE_NOW))
            kept.save(str(query.runId), stored)
    return metrics.saved_metrics(spark, stored).withColumn("arrival", F.col("batch") + 1).drop("batch")


QUERIES = {
    "csv_corrupt": csv_corrupt,
    "stream_corrupt": stream_corrupt,
    "stream_dedup": stream_dedup,
    "stream_state": stream_state,
    "stream_silence": stream_silence,
    "stream_metrics": stream_metrics,
}

_FIELDS_SQL = """f AS (
  SELECT o_orderkey % 10 AS kind, o_orderdate, CAST(o_orderkey AS VARCHAR) AS k, CAST(o_custkey AS VARCHAR) AS c,
    CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS p, strftime(o_orderdate, '%Y-%m-%d') AS d,
    o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(12,2)) AS price
  FROM orders)"""


def _split_sql(line: str, spoilt: str) -> str:
    return f"""WITH {_FIELDS_SQL},
l AS (SELECT *, {line} AS line, kind IN ({spoilt}) AS bad FROM f)
SELECT CASE WHEN NOT bad THEN o_orderkey END AS order_key, CASE WHEN NOT bad THEN o_custkey END AS customer,
  CASE WHEN NOT bad THEN CAST(price AS DOUBLE) END AS price,
  CASE WHEN NOT bad THEN CAST(o_orderdate AS TIMESTAMP) END AS placed,
  CASE WHEN bad THEN line END AS raw_line, CASE WHEN bad THEN 'malformed line' END AS reject_reason
FROM l"""


SQL = {
    "csv_corrupt": _split_sql(
        """CASE kind WHEN 1 THEN k || ',' || c WHEN 2 THEN concat_ws(',', k, c, p, d, 'more')
    WHEN 3 THEN concat_ws(',', k, c, 'n/a', d) WHEN 4 THEN concat_ws(',', k, c, p, '1999-02-30')
    WHEN 5 THEN concat_ws(',', 'no ' || k, c, p, d) END""",
        "1, 2, 3, 4, 5",
    ),
    "stream_corrupt": _split_sql(
        """CASE kind
    WHEN 1 THEN left(format('{{"order_key":{},"customer":{},"price":{},"placed":"{}"}}', k, c, p, d), 20)
    WHEN 3 THEN format('{{"order_key":{},"customer":{},"price":"n/a","placed":"{}"}}', k, c, d) END""",
        "1, 3",
    ),
    "stream_dedup": "SELECT event_id, ts, user_id, event_type FROM events",
    "stream_state": with_sales(
        f"""SELECT category, count(*) AS sales, CAST(sum(amount) AS DOUBLE) AS total
FROM enriched WHERE placed < DATE '{data.ARRIVAL_CUTS[1]}' GROUP BY category"""
    ),
    "stream_silence": f"""WITH gaps AS (
  SELECT user_id, ts AS last_seen, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_seen
  FROM events)
SELECT user_id, last_seen, last_seen + INTERVAL {SILENCE_SECONDS} SECOND AS silent_at FROM gaps
WHERE next_seen > last_seen + INTERVAL {SILENCE_SECONDS} SECOND OR (next_seen IS NULL
  AND epoch_ms(last_seen) + {SILENCE_SECONDS * 1000} + 1
    <= epoch_ms((SELECT max(ts) - INTERVAL 2 HOUR FROM events)))""",
    "stream_metrics": with_sales(
        f"""SELECT CAST(1 + (placed >= DATE '{data.ARRIVAL_CUTS[0]}')::INT
    + (placed >= DATE '{data.ARRIVAL_CUTS[1]}')::INT AS BIGINT) AS arrival, count(*) AS input_rows,
  count(*) FILTER (reject_reason IS NULL) AS accepted_rows, count(reject_reason) AS rejected_rows
FROM cleaned GROUP BY ALL"""
    ),
}
