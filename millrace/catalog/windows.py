"""Event-time windows over the whole events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import data
from millrace.catalog.streams import SESSIONS_SQL, SLIDING_SQL
from millrace.operators import windows


def win_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tumbling_counts(data.table(spark, sf_dir, "events"), "ts", "10 minutes")


def win_tumbling_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tumbling_counts(
        data.table(spark, sf_dir, "events"), "ts", "1 hour", "event_type"
    )


def win_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sliding_counts(data.table(spark, sf_dir, "events"), "ts", "1 hour", "15 minutes")


def win_sliding_uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows whose size is no multiple of the slide."""
    events = data.table(spark, sf_dir, "events")
    return windows.sliding_counts(events, "ts", "60 minutes", "25 minutes")


def win_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = data.table(spark, sf_dir, "events")
    sessions = windows.session_counts(events, "ts", 8 * 3600, "user_id")
    return sessions.select(
        F.col("session_start").alias("window_start"),
        F.col("session_end").alias("window_end"),
        "user_id",
        "events",
    )


QUERIES = {
    "win_tumbling": win_tumbling,
    "win_tumbling_key": win_tumbling_key,
    "win_sliding": win_sliding,
    "win_sliding_uneven": win_sliding_uneven,
    "win_session": win_session,
}

SQL = {
    "win_tumbling": """SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS window_start,
  time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE AS window_end, count(*) AS events
FROM events GROUP BY ALL""",
    "win_tumbling_key": """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
  time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS events
FROM events GROUP BY ALL""",
    "win_sliding": SLIDING_SQL,
    "win_sliding_uneven": """SELECT make_timestamp(s) AS window_start,
  make_timestamp(s + 3600000000) AS window_end, count(*) AS events
FROM (SELECT epoch_us(ts) AS e, (epoch_us(ts) // 1500000000 - k) * 1500000000 AS s
      FROM events, range(3) AS r(k))
WHERE s + 3600000000 > e GROUP BY s""",
    "win_session": f"""WITH {SESSIONS_SQL}
SELECT window_start, window_end, user_id, events FROM sessions""",
}
