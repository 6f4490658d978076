"""Event-time counts over bounded tables. ``streaming.event_time`` holds the streaming forms."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from millrace.operators.joins import fair_share, heavy_digests, key_digest
from millrace.scratch import cut_lineage

CHUNK_GAPS = 256


def tumbling_counts(frame: DataFrame, time: str, size: str, *keys: str) -> DataFrame:
    """Rows per fixed window, and per key if any are named."""
    return frame.groupBy(F.window(time, size), *keys).agg(F.count(F.lit(1)).alias("events")).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *keys,
        "events",
    )


def sliding_counts(frame: DataFrame, time: str, size: str, slide: str, *keys: str) -> DataFrame:
    """Rows per overlapping window, of any size and slide.

    Rows are first counted per pane, and only the panes are repeated for the windows they lie in.
    A pane is as wide as the largest step that divides both size and slide.
    """
    pane = math.gcd(_interval_micros(frame, size), _interval_micros(frame, slide))
    panes = frame.groupBy(F.window(time, f"{pane} microseconds").alias("pane"), *keys).agg(
        F.count(F.lit(1)).alias("pane_events")
    )
    return (
        panes.groupBy(F.window("pane.start", size, slide), *keys)
        .agg(F.sum("pane_events").alias("events"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *keys,
            "events",
        )
    )


def _interval_micros(frame: DataFrame, text: str) -> int:
    """An interval such as ``10 minutes`` in microseconds; months have no fixed length."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    length = F.unix_micros((start + F.expr(f"INTERVAL '{text}'")).cast("timestamp"))
    return frame.sparkSession.range(1).select(length - F.unix_micros(start.cast("timestamp"))).first()[0]


def session_counts(
    frame: DataFrame,
    time: str,
    gap_seconds: int,
    *keys: str,
    chunk_gaps: int = CHUNK_GAPS,
    share: float | None = None,
) -> DataFrame:
    """Rows per session: a session ends once nothing came for longer than ``gap_seconds``.

    Keys with up to ``share`` of the rows (by default what a shuffle partition would hold of rows
    spread evenly) take Spark's session window. The timeline of a key with more, or of all rows
    where no key is named, is cut into chunks ``chunk_gaps`` gaps long, and sessions are built per
    key and chunk, so it is spread over many tasks. There, rows within one gap-wide bucket, which
    always share a session, shrink to one before the shuffle. Only sessions within a gap of a
    chunk's ends, at most two per key and chunk, can go on in the next chunk and are merged again.

    Starts jobs: one looks for such keys; if there are any, one stores the sessions of the chunks.
    """
    gap = gap_seconds * 1_000_000
    width = F.lit(gap * chunk_gaps).cast("bigint")
    rows = frame.where(F.col(time).isNotNull()).select(
        *keys,
        F.col(time).alias("first_at"),
        F.col(time).alias("last_at"),
        F.lit(1).cast("bigint").alias("n"),
    )
    parts, found, busy, quiet = [*keys, "_chunk"], None, rows, None
    if keys:
        share = fair_share(rows) if share is None else share
        heavy = [digest for digest, _ in heavy_digests(rows, keys, share)[0]]
        among = key_digest(rows, keys).isin(heavy)
        busy, quiet = (rows.where(among) if heavy else None), (rows.where(~among) if heavy else rows)
    if quiet is not None:
        session = F.session_window("first_at", f"{gap_seconds} seconds")
        found = _spans(quiet.groupBy(*keys, session), keys)
    if busy is not None:
        cut = busy.withColumn("_chunk", _micros("first_at") - F.pmod(_micros("first_at"), width))
        bucket = F.window("first_at", f"{gap_seconds} seconds")
        within = _merged(_spans(cut.groupBy(*parts, bucket), parts), gap, parts)
        # Two readers follow; without a stored copy each would sort and merge all rows again.
        stored = cut_lineage(within, "sessions")
        start = F.col("_chunk")
        at_an_end = (_micros("first_at") - start <= gap) | (start + width - _micros("last_at") <= gap)
        whole = stored.where(~at_an_end).drop("_chunk")
        whole = whole.unionByName(_merged(stored.where(at_an_end), gap, keys))
        found = whole if found is None else found.unionByName(whole)
    return found.select(
        F.col("first_at").alias("session_start"),
        (F.col("last_at") + F.make_dt_interval(secs=F.lit(gap_seconds))).alias("session_end"),
        *keys,
        F.col("n").alias("events"),
    )


def _micros(time: str) -> Column:
    return F.unix_micros(F.col(time).cast("timestamp"))


def _spans(grouped: GroupedData, keys: Sequence[str]) -> DataFrame:
    return grouped.agg(
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
        F.sum("n").alias("n"),
    ).select(*keys, "first_at", "last_at", "n")


def _merged(spans: DataFrame, gap: int, keys: Sequence[str]) -> DataFrame:
    """Spans of a key that lie no more than the gap apart become one."""
    reach = (_micros("last_at") - _micros("first_at") + F.lit(gap)).cast("decimal(20,0)")
    seconds = (reach / F.lit(1_000_000)).cast("decimal(18,6)")
    return _spans(
        spans.groupBy(*keys, F.session_window("first_at", F.make_interval(secs=seconds))), keys
    )
