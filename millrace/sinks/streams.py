"""Stream outputs. Every durable sink takes its own checkpoint folder."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

FOLD_EVERY = 16
BASE = "-base"


def write_stream(
    frame: DataFrame,
    sink: str,
    mode: str = "append",
    checkpoint: str | None = None,
    path: str | None = None,
    trigger: Mapping[str, object] | None = None,
    options: Mapping[str, object] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start a query on any sink by name: parquet, kafka, memory, console, noop, ..."""
    writer = _writer(frame, mode, checkpoint, trigger, name).format(sink)
    writer = writer.options(**dict(options or {}))
    return writer.start(path) if path is not None else writer.start()


def to_files(frame: DataFrame, path: str, checkpoint: str, **kwargs) -> StreamingQuery:
    """Append final rows to Parquet files. The sink's log hides files of an unfinished batch."""
    return write_stream(frame, "parquet", "append", checkpoint, path, **kwargs)


def to_memory(frame: DataFrame, table: str, mode: str = "append", **kwargs) -> StreamingQuery:
    """A table in the driver, for looking at small results while developing."""
    return write_stream(frame, "memory", mode, name=table, **kwargs)


def to_console(frame: DataFrame, mode: str = "append", **kwargs) -> StreamingQuery:
    return write_stream(frame, "console", mode, **kwargs)


def to_batches(
    frame: DataFrame,
    save: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Hand every batch with its number to ``save``.

    A batch may be handed over again after a failure, so ``save`` must be repeatable;
    ``batch_folder`` and ``split_by_reason`` are.
    """
    return _writer(frame, mode, checkpoint, trigger).foreachBatch(save).start()


def to_row_writer(
    frame: DataFrame,
    writer: object,
    checkpoint: str,
    mode: str = "append",
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Send rows one by one to a writer with open / process / close. Slow; prefer to_batches."""
    return _writer(frame, mode, checkpoint, trigger).foreach(writer).start()


def batch_folder(folder: str) -> Callable[[DataFrame, int], None]:
    """Save each batch to its own sub-folder; a repeated batch replaces itself."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    return save


def folded_batches(
    folder: str, *keys: str, every: int = FOLD_EVERY
) -> Callable[[DataFrame, int], None]:
    """``batch_folder`` for update mode that also folds old batches into the newest row per key.

    After every so many batches the rows that ``latest_per_key`` would give are stored beside the
    batches, so that a reader needs only that base and the batches since.
    """
    save_batch = batch_folder(folder)

    def save(batch: DataFrame, batch_id: int) -> None:
        save_batch(batch, batch_id)
        if batch_id % every == every - 1:
            base = latest_per_key(batch.sparkSession, folder, *keys, through=batch_id)
            base.write.mode("overwrite").parquet(f"{folder}{BASE}/through={batch_id}")

    return save


def split_by_reason(folder: str, reason: str = "reject_reason") -> Callable[[DataFrame, int], None]:
    """Save accepted and rejected rows of a batch apart, in one write that parses it once.

    ``accepted_batches`` and ``rejected_batches`` read them.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        outcome = F.when(F.col(reason).isNull(), "accepted").otherwise("rejected")
        marked = batch.withColumn("outcome", outcome)
        marked.write.mode("overwrite").partitionBy("outcome").parquet(f"{folder}/batch_id={batch_id}")

    return save


def accepted_batches(spark: SparkSession, folder: str, reason: str = "reject_reason") -> DataFrame:
    rows = all_batches(spark, folder).where(F.col("outcome") == "accepted")
    return rows.drop("outcome", "batch_id", reason)


def rejected_batches(spark: SparkSession, folder: str) -> DataFrame:
    rows = all_batches(spark, folder).where(F.col("outcome") == "rejected")
    return rows.drop("outcome", "batch_id")


def all_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Everything that finished batches saved, with ``batch_id``; raises if none has finished.

    A batch whose write did not end is passed over: its rows come when it is repeated.
    """
    finished = _complete(spark, folder, "batch_id")
    if not finished:
        raise FileNotFoundError(f"no batch in {folder} has finished")
    return spark.read.option("basePath", folder).parquet(*[f"{folder}/batch_id={b}" for b in finished])


def latest_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The newest complete batch: for complete mode, the whole current report.

    Found from the folder's names; no older batch is opened.
    """
    return spark.read.parquet(f"{folder}/batch_id={_complete(spark, folder, 'batch_id')[-1]}")


def latest_per_key(
    spark: SparkSession, folder: str, *keys: str, through: int | None = None
) -> DataFrame:
    """The newest row per key: for update mode, whose batches hold only what changed.

    Reads the newest base that ``folded_batches`` stored, if any, and the batches after it.
    """
    batches = _complete(spark, folder, "batch_id")
    bases = _complete(spark, folder + BASE, "through")
    if through is not None:
        batches = [b for b in batches if b <= through]
        bases = [b for b in bases if b < through]
    parts = [f"{folder}/batch_id={b}" for b in batches if not bases or b > bases[-1]]
    saved = spark.read.option("basePath", folder).parquet(*parts) if parts else None
    if bases:
        base = spark.read.parquet(f"{folder}{BASE}/through={bases[-1]}")
        base = base.withColumn("batch_id", F.lit(bases[-1]))
        saved = base if saved is None else saved.unionByName(base)
    rest = [c for c in saved.columns if c not in {*keys, "batch_id"}]
    # One plain value each keeps the aggregate in a hash table.
    return saved.groupBy(*keys).agg(*[F.max_by(c, "batch_id").alias(c) for c in rest])


def _complete(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Numbers of the sub-folders ``name=number`` whose write ended, ascending."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(path):
        return []
    found = []
    for entry in store.listStatus(path):
        label, _, number = entry.getPath().getName().partition("=")
        done = spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS")
        if label == name and store.exists(done):
            found.append(int(number))
    return sorted(found)


def _writer(
    frame: DataFrame,
    mode: str,
    checkpoint: str | None,
    trigger: Mapping[str, object] | None,
    name: str | None = None,
) -> DataStreamWriter:
    writer = frame.writeStream.outputMode(mode)
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    if trigger is not None:
        writer = writer.trigger(**trigger)
    if name is not None:
        writer = writer.queryName(name)
    return writer
