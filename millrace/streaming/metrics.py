"""Counts that a running stream takes of its own rows, kept per batch."""

from __future__ import annotations

import threading
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

METRICS = "counts"


def outcome_counts(reason: str = "reject_reason") -> dict[str, Column]:
    """Input, accepted and rejected rows of a cleaned frame, and the amount that was accepted."""
    good = F.col(reason).isNull()
    return {
        "input_rows": F.count(F.lit(1)),
        "accepted_rows": F.count_if(good),
        "rejected_rows": F.count_if(~good),
    }


def observed(stream: DataFrame, metrics: Mapping[str, Column], name: str = METRICS) -> DataFrame:
    """The same rows; the metrics are taken as they pass, without a second read or a shuffle."""
    return stream.observe(name, *[value.alias(label) for label, value in metrics.items()])


class BatchMetrics(StreamingQueryListener):
    """Keeps what one query observed, per batch; a repeated batch replaces its figures.

    Use ``with BatchMetrics(spark) as kept``, start the query inside, and read ``kept.rows(query)`` after
    it has ended. Figures are a few numbers per batch and stand in the driver until ``save``.
    """

    def __init__(self, spark: SparkSession, name: str = METRICS):
        self.spark, self.name = spark, name
        self.kept: dict[str, dict[int, dict]] = {}
        self.ended: dict[str, threading.Event] = {}

    def __enter__(self) -> BatchMetrics:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error: object) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found = progress.observedMetrics.get(self.name)
        if found is not None and progress.numInputRows:
            batches = self.kept.setdefault(str(progress.runId), {})
            batches[progress.batchId] = found.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def rows(self, run_id: str, seconds: float = 60) -> dict[int, dict]:
        """Figures per batch of a run that has ended; its last events may still be on their way."""
        if not self.ended.setdefault(run_id, threading.Event()).wait(seconds):
            raise TimeoutError(f"no end of run {run_id} was heard of in {seconds} s")
        return dict(self.kept.get(run_id, {}))

    def save(self, run_id: str, folder: str) -> None:
        """Store a run's figures, a folder per batch; a batch stored before is replaced."""
        for batch, figures in self.rows(run_id).items():
            row = self.spark.createDataFrame([{"batch": batch, **figures}])
            row.coalesce(1).write.mode("overwrite").json(f"{folder}/batch_id={batch}")


def saved_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Everything ``BatchMetrics.save`` stored: one row per batch."""
    return spark.read.json(f"{folder}/*")
