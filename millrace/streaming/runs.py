"""Run, watch, stop and resume streaming queries."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.plans.reading import plan_text

AVAILABLE_NOW = {"availableNow": True}


def finish(query: StreamingQuery, seconds: float | None = None) -> StreamingQuery:
    """Wait for a query that ends by itself, however long its backlog takes.

    Given ``seconds``, stop it and raise if it does not end in time.
    """
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"query {query.name or query.id} still ran after {seconds} s")
    return query


def drain(query: StreamingQuery) -> StreamingQuery:
    """Let a running query take in all that has arrived, then stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def status(query: StreamingQuery) -> dict[str, object]:
    """Whether a query runs, which batch it did last, and how many rows that batch took in."""
    progress = query.lastProgress
    return {
        "name": query.name,
        "active": query.isActive,
        "batch": None if progress is None else progress["batchId"],
        "input_rows": None if progress is None else progress["numInputRows"],
    }


def stop_all(spark: SparkSession) -> None:
    for query in spark.streams.active:
        query.stop()


def plan_fingerprint(stream: DataFrame) -> str:
    """A short mark of what a streaming frame computes; equal for equal transformations.

    Taken from the whole plan, however many columns it has. Join hints play no part, so a lookup
    that outgrows a broadcast leaves the mark as it was.
    """
    conf, whole = stream.sparkSession.conf, "spark.sql.debug.maxToStringFields"
    before = conf.get(whole)
    conf.set(whole, str(2**31 - 1))
    try:
        text = plan_text(stream, "extended")
    finally:
        conf.set(whole, before)
    analysed = text.split("== Analyzed Logical Plan ==")[1].split("== Optimized Logical Plan ==")[0]
    steps = [line.lstrip(" :+-") for line in analysed.splitlines()]
    marked = "\n".join(step for step in steps if not step.startswith("ResolvedHint"))
    # Ids differ from one session to the next; numbered as they appear, they still tell columns apart.
    seen: dict[str, str] = {}
    marked = re.sub(r"#\d+", lambda m: seen.setdefault(m[0], f"#{len(seen)}"), marked)
    return hashlib.sha256(marked.encode()).hexdigest()


def remember_boundary(stream: DataFrame, folder: str, arrival: int) -> None:
    """Note beside a checkpoint what the query computes and which arrival it has taken in."""
    note = stream.sparkSession.createDataFrame(
        [(arrival, plan_fingerprint(stream))], "arrival INT, fingerprint STRING"
    )
    note.coalesce(1).write.mode("errorifexists").json(f"{folder}/boundary/{arrival}")


def require_boundary(stream: DataFrame, folder: str, after: int) -> None:
    """Refuse to resume unless the last note names this arrival and these transformations."""
    notes = stream.sparkSession.read.schema("arrival INT, fingerprint STRING").json(
        f"{folder}/boundary/*"
    )
    last = notes.agg(
        F.max("arrival").alias("arrival"), F.max_by("fingerprint", "arrival").alias("fingerprint")
    ).first()
    if last["arrival"] != after:
        raise ValueError(f"the stream was left after arrival {last['arrival']}, not {after}")
    if last["fingerprint"] != plan_fingerprint(stream):
        raise ValueError("another computation wrote this checkpoint; take a new folder")


def run_now(start: Callable[[], StreamingQuery], seconds: float | None = None) -> dict:
    """Start a query made with ``AVAILABLE_NOW``, wait for its end and return its status.

    ``run_rows`` are the rows of all its batches still remembered (a hundred, if not set).
    """
    query = finish(start(), seconds)
    rows = sum(progress["numInputRows"] for progress in query.recentProgress)
    return {**status(query), "run_rows": rows}
