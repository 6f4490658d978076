"""Streaming queries: arrivals are published to a landing folder and run to the end.

Each call uses new landing, checkpoint and output folders. Every run takes in all that has
arrived (``availableNow``), so batches grow with the data instead of being capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import data
from millrace.catalog.cleaning import CATEGORY_REPORT_SQL
from millrace.catalog.data import with_sales
from millrace.catalog.reports import SQL as REPORT_SQL
from millrace.operators.cleaning import accepted, clean_sales
from millrace.operators.quality import stored_once
from millrace.operators.reports import category_totals, word_count
from millrace.scratch import fresh_folder
from millrace.sinks import streams as sinks
from millrace.sinks.files import publish_arrival
from millrace.sources.streams import arrivals, read_stream
from millrace.sources.tables import read_table
from millrace.streaming import event_time
from millrace.streaming.lookups import enrich_stream
from millrace.streaming.runs import (
    AVAILABLE_NOW,
    drain,
    finish,
    remember_boundary,
    require_boundary,
    run_now,
)

WATERMARK = "2 hours"
FOLLOW_UP_SECONDS = 3600


def _sold_stream(spark: SparkSession, sf_dir: str, landing: str) -> DataFrame:
    raw = arrivals(spark, landing, data.RAW_SALES_DDL)
    return enrich_stream(accepted(clean_sales(raw)), data.lookup(spark, sf_dir))


def _report_run(report: DataFrame, folder: str, checkpoint: str) -> None:
    finish(
        sinks.to_batches(
            report, sinks.batch_folder(folder), checkpoint, "complete", AVAILABLE_NOW
        )
    )


def stream_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running report after each of three arrivals, each run resuming the last checkpoint."""
    landing, output = fresh_folder(spark, "landing"), fresh_folder(spark, "running-report")
    checkpoint = fresh_folder(spark, "checkpoint")
    snapshots = []
    for number, rows in enumerate(data.sales_arrivals(spark, sf_dir), 1):
        publish_arrival(rows, landing, f"{number:02d}")
        _report_run(category_totals(_sold_stream(spark, sf_dir, landing)), output, checkpoint)
        snapshots.append(
            sinks.latest_batch(spark, output).withColumn("arrival", F.lit(number).cast("bigint"))
        )
    return snapshots[0].unionByName(snapshots[1]).unionByName(snapshots[2])


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stopped query, two further arrivals, and a new query on the same checkpoint."""
    slices = data.sales_arrivals(spark, sf_dir)
    landing, output = data.land(spark, slices[:1], "landing"), fresh_folder(spark, "restart")
    checkpoint = fresh_folder(spark, "checkpoint")
    _report_run(category_totals(_sold_stream(spark, sf_dir, landing)), output, checkpoint)
    for number, rows in enumerate(slices[1:], 2):
        publish_arrival(rows, landing, f"{number:02d}")
    _report_run(category_totals(_sold_stream(spark, sf_dir, landing)), output, checkpoint)
    return sinks.latest_batch(spark, output)


def stream_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files read twice under different checkpoints: two histories, equal reports."""
    landing = data.land(spark, data.sales_arrivals(spark, sf_dir), "landing")
    reports = []
    for history in ("first", "fresh"):
        output = fresh_folder(spark, f"{history}-report")
        report = category_totals(_sold_stream(spark, sf_dir, landing))
        _report_run(report, output, fresh_folder(spark, "checkpoint"))
        reports.append(
            sinks.latest_batch(spark, output).withColumn("history", F.lit(history))
        )
    return reports[0].unionByName(reports[1])


def stream_memory_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report in a driver-side table, which suits a handful of categories."""
    landing = data.land(spark, data.sales_arrivals(spark, sf_dir), "landing")
    name = fresh_folder(spark, "report").rsplit("/", 1)[1].replace("-", "_")
    drain(
        sinks.to_memory(category_totals(_sold_stream(spark, sf_dir, landing)), name, "complete")
    )
    return read_table(spark, name)


def _stored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = data.land(spark, data.sales_arrivals(spark, sf_dir), "landing")
    output = fresh_folder(spark, "sold")
    finish(
        sinks.to_files(
            _sold_stream(spark, sf_dir, landing),
            output,
            fresh_folder(spark, "checkpoint"),
            trigger=AVAILABLE_NOW,
        )
    )
    return spark.read.parquet(output)


def stream_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_rows(spark, sf_dir)


def stream_rows_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_once(_stored_rows(spark, sf_dir))


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and rejected rows of one stream saved to two places; both are returned."""
    landing = data.land(spark, data.sales_arrivals(spark, sf_dir), "landing")
    output = fresh_folder(spark, "split")
    parsed = clean_sales(arrivals(spark, landing, data.RAW_SALES_DDL))
    finish(
        sinks.to_batches(
            parsed,
            sinks.split_by_reason(output),
            fresh_folder(spark, "checkpoint"),
            trigger=AVAILABLE_NOW,
        )
    )
    return sinks.rejected_batches(spark, output).unionByName(
        sinks.accepted_batches(spark, output), allowMissingColumns=True
    )


def _document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "lines")
    data.table(spark, sf_dir, "documents").select("text").write.text(folder)
    return read_stream(spark, "text", folder)


def stream_words_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    output = fresh_folder(spark, "words")
    counts = word_count(_document_lines(spark, sf_dir))
    _report_run(counts, output, fresh_folder(spark, "checkpoint"))
    return sinks.latest_batch(spark, output)


def stream_words_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents arrive by language; each batch holds the new totals of the words it touched."""
    landing, output = fresh_folder(spark, "landing"), fresh_folder(spark, "words")
    checkpoint = fresh_folder(spark, "checkpoint")
    documents = data.table(spark, sf_dir, "documents")
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    for name, part in (("en", documents.where(english)), ("other", documents.where(~english))):
        part.select("text").write.mode("errorifexists").text(f"{landing}/{name}")
        counts = word_count(read_stream(spark, "text", f"{landing}/*"))
        finish(
            sinks.to_batches(
                counts, sinks.folded_batches(output, "word"), checkpoint, "update", AVAILABLE_NOW
            )
        )
    return sinks.latest_per_key(spark, output, "word")


def stream_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as CSV, JSON and ORC files, each streamed with a declared schema."""
    schema = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE"
    events = data.table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value"
    )
    results = []
    for source in ("csv", "json", "orc"):
        folder, output = fresh_folder(spark, source), fresh_folder(spark, f"from-{source}")
        events.write.format(source).save(folder)
        stream = read_stream(spark, source, folder, schema)
        finish(
            sinks.to_files(
                stream, output, fresh_folder(spark, "checkpoint"), trigger=AVAILABLE_NOW
            )
        )
        results.append(spark.read.parquet(output).withColumn("source", F.lit(source)))
    every = results[0].unionByName(results[1]).unionByName(results[2])
    return every.groupBy("source", "event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.col("value").cast("decimal(12,2)")).alias("total"),
    )


def _event_stream(spark: SparkSession, landing: str) -> DataFrame:
    schema = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING"
    return event_time.watermarked(arrivals(spark, landing, schema), "ts", WATERMARK)


def _append_windows(
    spark: SparkSession, sf_dir: str, build, late_minutes: int = 0
) -> DataFrame:
    """Run a windowed query after each arrival; the watermark and open windows carry over."""
    landing, output = fresh_folder(spark, "events"), fresh_folder(spark, "windows")
    checkpoint = fresh_folder(spark, "checkpoint")
    for number, rows in enumerate(data.event_arrivals(spark, sf_dir, late_minutes), 1):
        publish_arrival(rows, landing, f"{number:02d}")
        counts = build(_event_stream(spark, landing))
        finish(sinks.to_files(counts, output, checkpoint, trigger=AVAILABLE_NOW))
    return spark.read.parquet(output)


def win_watermark_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly windows, written once the watermark has passed their end."""
    return _append_windows(
        spark, sf_dir, lambda s: event_time.window_counts(s, "ts", "1 hour", "event_type")
    )


def win_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events delivered up to 90 minutes late, out of order, inside the delay that is waited for."""
    return _append_windows(
        spark, sf_dir, lambda s: event_time.window_counts(s, "ts", "1 hour", "event_type"), 90
    )


def stream_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that each run took in, as the finished queries report them."""
    landing, output = fresh_folder(spark, "landing"), fresh_folder(spark, "sold")
    checkpoint, found = fresh_folder(spark, "checkpoint"), []
    for number, rows in enumerate(data.sales_arrivals(spark, sf_dir), 1):
        publish_arrival(rows, landing, f"{number:02d}")
        stream = arrivals(spark, landing, data.RAW_SALES_DDL)
        run = run_now(lambda s=stream: sinks.to_files(s, output, checkpoint, trigger=AVAILABLE_NOW))
        found.append((number, run["active"], run["run_rows"]))
    return spark.createDataFrame(found, "arrival BIGINT, active BOOLEAN, run_rows BIGINT")


def stream_timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query on a processing-time trigger takes in all arrivals and is stopped."""
    landing = data.land(spark, data.sales_arrivals(spark, sf_dir), "landing")
    output = fresh_folder(spark, "sold")
    drain(
        sinks.to_files(
            _sold_stream(spark, sf_dir, landing),
            output,
            fresh_folder(spark, "checkpoint"),
            trigger={"processingTime": "500 milliseconds"},
        )
    )
    return spark.read.parquet(output)


def stream_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the guard says to the same computation, a changed one, and a wrong arrival."""
    landing = data.land(spark, data.sales_arrivals(spark, sf_dir)[:1], "landing")
    folder = fresh_folder(spark, "guarded")
    report = category_totals(_sold_stream(spark, sf_dir, landing))
    _report_run(report, f"{folder}/report", f"{folder}/checkpoint")
    remember_boundary(report, folder, 1)
    rows = sinks.latest_batch(spark, f"{folder}/report").agg(F.sum("sales")).first()[0]
    changed = report.withColumn("total", F.col("total") * 2)
    found = []
    for case, stream, after in (("same", report, 1), ("changed", changed, 1), ("elsewhere", report, 2)):
        try:
            require_boundary(stream, folder, after)
            found.append((case, True, rows))
        except ValueError:
            found.append((case, False, rows))
    return spark.createDataFrame(found, "case STRING, resumes BOOLEAN, sales BIGINT")


def win_session_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User sessions, written once the watermark has passed their end."""
    return _append_windows(
        spark, sf_dir, lambda s: event_time.session_counts(s, "ts", "8 hours", "user_id")
    )


def win_sliding_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding windows with provisional counts; the newest count per window is returned."""
    landing, output = fresh_folder(spark, "events"), fresh_folder(spark, "windows")
    checkpoint = fresh_folder(spark, "checkpoint")
    for number, rows in enumerate(data.event_arrivals(spark, sf_dir), 1):
        publish_arrival(rows, landing, f"{number:02d}")
        counts = event_time.window_counts(
            _event_stream(spark, landing), "ts", "1 hour", slide="15 minutes"
        )
        finish(
            sinks.to_batches(
                counts,
                sinks.folded_batches(output, "window_start", "window_end"),
                checkpoint,
                "update",
                AVAILABLE_NOW,
            )
        )
    return sinks.latest_per_key(spark, output, "window_start", "window_end")


def stream_stream_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases within an hour after a click of the same user. Clicks outlast a restart in state."""
    output, checkpoint = fresh_folder(spark, "follow-ups"), fresh_folder(spark, "checkpoint")
    *earlier, last = data.event_arrivals(spark, sf_dir)
    landing = data.land(spark, earlier, "events")
    _run_follow_ups(spark, landing, output, checkpoint)
    publish_arrival(last, landing, "last")
    _run_follow_ups(spark, landing, output, checkpoint)
    return spark.read.parquet(output)


def _run_follow_ups(spark: SparkSession, landing: str, output: str, checkpoint: str) -> None:
    events = _event_stream(spark, landing)
    clicks = events.where(F.col("event_type") == "click").select(
        "user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("clicked_at")
    )
    purchases = events.where(F.col("event_type") == "purchase").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("bought_at")
    )
    pairs = event_time.follow_ups(
        clicks, purchases, "user_id", "clicked_at", "bought_at", FOLLOW_UP_SECONDS
    )
    finish(sinks.to_files(pairs, output, checkpoint, trigger=AVAILABLE_NOW))


QUERIES = {
    "stream_report": stream_report,
    "stream_restart": stream_restart,
    "stream_fresh": stream_fresh,
    "stream_memory_table": stream_memory_table,
    "stream_rows": stream_rows,
    "stream_rows_once": stream_rows_once,
    "stream_rejects": stream_rejects,
    "stream_words_complete": stream_words_complete,
    "stream_words_update": stream_words_update,
    "stream_formats": stream_formats,
    "win_watermark_append": win_watermark_append,
    "win_session_append": win_session_append,
    "win_sliding_update": win_sliding_update,
    "stream_stream_join": stream_stream_join,
    "win_out_of_order": win_out_of_order,
    "stream_status": stream_status,
    "stream_timed": stream_timed,
    "stream_guard": stream_guard,
}

SESSIONS_SQL = """marked AS (
  SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
    <= INTERVAL 8 HOUR THEN 0 ELSE 1 END AS opens, event_id FROM events),
numbered AS (
  SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM marked),
sessions AS (
  SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 8 HOUR AS window_end,
    count(*) AS events FROM numbered GROUP BY user_id, n)"""
SLIDING_SQL = """SELECT time_bucket(INTERVAL 15 MINUTE, ts) - k * INTERVAL 15 MINUTE AS window_start,
  time_bucket(INTERVAL 15 MINUTE, ts) - k * INTERVAL 15 MINUTE + INTERVAL 1 HOUR AS window_end,
  count(*) AS events
FROM events, range(4) AS r(k) GROUP BY ALL"""
_CLOSED = "(SELECT max(ts) - INTERVAL 2 HOUR FROM events)"
_CLOSED_WINDOWS_SQL = f"""SELECT window_start, window_end, event_type, events FROM (
  SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
    time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, event_type,
    count(*) AS events
  FROM events GROUP BY ALL)
WHERE window_end <= {_CLOSED}"""
_SOLD_SQL = with_sales(
    """SELECT sale_id, product_id, CAST(amount AS DOUBLE) AS amount, sold_at, category
FROM enriched"""
)

SQL = {
    "stream_report": with_sales(
        f"""SELECT CAST(arrival AS BIGINT) AS arrival, category, count(*) AS sales,
  CAST(sum(amount) AS DOUBLE) AS total
FROM enriched, (VALUES (1, DATE '{data.ARRIVAL_CUTS[0]}'), (2, DATE '{data.ARRIVAL_CUTS[1]}'),
  (3, DATE '9999-12-31')) AS v(arrival, before)
WHERE placed < before GROUP BY arrival, category"""
    ),
    "stream_restart": CATEGORY_REPORT_SQL,
    "stream_fresh": with_sales(
        """SELECT category, count(*) AS sales, CAST(sum(amount) AS DOUBLE) AS total, history
FROM enriched, (VALUES ('first'), ('fresh')) AS v(history) GROUP BY category, history"""
    ),
    "stream_memory_table": CATEGORY_REPORT_SQL,
    "stream_rows": _SOLD_SQL,
    "stream_rows_once": with_sales(
        """SELECT count(*) AS rows, count(DISTINCT sale_id) AS distinct_keys,
  CAST(0 AS BIGINT) AS repeated_keys FROM enriched"""
    ),
    "stream_rejects": with_sales(
        """SELECT sale_id, product_id, amount_raw, sold_at_raw, CAST(amount AS DOUBLE) AS amount,
  sold_at, reject_reason FROM cleaned"""
    ),
    "stream_words_complete": REPORT_SQL["text_scan"],
    "stream_words_update": REPORT_SQL["text_scan"],
    "stream_formats": """SELECT source, event_type, count(*) AS events,
  CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total
FROM events, (VALUES ('csv'), ('json'), ('orc')) AS v(source) GROUP BY source, event_type""",
    "win_watermark_append": _CLOSED_WINDOWS_SQL,
    "win_out_of_order": _CLOSED_WINDOWS_SQL,
    "stream_status": with_sales(
        f"""SELECT CAST(1 + (placed >= DATE '{data.ARRIVAL_CUTS[0]}')::INT
    + (placed >= DATE '{data.ARRIVAL_CUTS[1]}')::INT AS BIGINT) AS arrival,
  false AS active, count(*) AS run_rows FROM sales GROUP BY ALL"""
    ),
    "stream_timed": _SOLD_SQL,
    "stream_guard": with_sales(
        f"""SELECT v.name AS "case", v.resumes, (SELECT count(*) FROM enriched
  WHERE placed < DATE '{data.ARRIVAL_CUTS[0]}') AS sales
FROM (VALUES ('same', true), ('changed', false), ('elsewhere', false)) AS v(name, resumes)"""
    ),
    "win_session_append": f"""WITH {SESSIONS_SQL}
SELECT window_start, window_end, user_id, events FROM sessions WHERE window_end <= {_CLOSED}""",
    "win_sliding_update": SLIDING_SQL,
    "stream_stream_join": """SELECT c.user_id, c.event_id AS click_id, c.ts AS clicked_at,
  p.event_id AS purchase_id, p.ts AS bought_at
FROM events c JOIN events p ON c.user_id = p.user_id AND p.ts >= c.ts
  AND p.ts <= c.ts + INTERVAL 1 HOUR
WHERE c.event_type = 'click' AND p.event_type = 'purchase'""",
}
