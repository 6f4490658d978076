"""Bounded outputs."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

from millrace.operators.quality import row_marks


def write_once(frame: DataFrame, path: str) -> str:
    """Write Parquet and refuse a path that exists, so no earlier result is replaced."""
    frame.write.mode("errorifexists").parquet(path)
    return path


def write_with_audit(report: DataFrame, rejected_rows: DataFrame, folder: str) -> tuple[str, str]:
    """A report and, beside it, the rejected rows with their raw values and reasons."""
    return write_once(report, f"{folder}/report"), write_once(rejected_rows, f"{folder}/rejected")


def write_verified(frame: DataFrame, path: str) -> DataFrame:
    """Write once, read back, and raise unless the stored rows are the given ones.

    The rows are counted and their hashes summed while they are written, and again while they are
    read: one pass each, no shuffle, in any order.
    """
    written = Observation()
    write_once(frame.observe(written, *row_marks(frame)), path)
    stored = frame.sparkSession.read.parquet(path)
    if stored.agg(*row_marks(stored)).first().asDict() != written.get:
        raise ValueError(f"rows read back from {path} differ from those written")
    return stored


def write_csv(frame: DataFrame, path: str) -> str:
    """CSV with a header; spaces around a value survive the round trip."""
    (
        frame.write.mode("errorifexists")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def write_in_files(frame: DataFrame, path: str, files: int) -> str:
    """Write a small report in this many files (fewer only if it has fewer rows).

    The result is redistributed after it is computed, so the work above keeps all its tasks
    (merging partitions instead would leave that work to as many tasks as there are files). For
    large tables let the input decide the number of files, or set ``maxRecordsPerFile``.
    """
    return write_once(frame.repartition(files), path)


def publish_arrival(frame: DataFrame, landing: str, name: str) -> str:
    """Deliver finished files to a landing folder as one arrival, at most once.

    An arrival is a sub-folder. It is written under a name that readers pass over and renamed when
    complete, so a stream sees all of it or nothing (on stores that rename folders in one step). Of
    several deliverers one wins: the name is claimed by creating a file that must not exist, which
    names the folder to be renamed. A delivery that failed before its claim can be repeated; one that
    failed after it is finished by the next attempt, which is refused like any second delivery.
    """
    spark = frame.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    target, claim = path(f"{landing}/{name}"), path(f"{landing}/_unfinished/_{name}.claim")
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(target) and not store.exists(claim):
        staged = write_once(frame, f"{landing}/_unfinished/{name}-{uuid.uuid4().hex}")
        if _claimed(spark, store, claim, staged):
            store.rename(path(staged), target)
            return f"{landing}/{name}"
    if not store.exists(target):
        _finish_claimed(spark, store, claim, target)
    raise FileExistsError(f"{name} was delivered to {landing} before")


def _claimed(spark: SparkSession, store, claim, staged: str) -> bool:
    """Whether this call created the claim."""
    try:
        out = store.create(claim, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName() or store.exists(claim):
            return False
        raise
    out.write(bytearray(staged.encode()))
    out.close()
    return True


def _finish_claimed(spark: SparkSession, store, claim, target) -> None:
    """Rename what an interrupted delivery had claimed; renaming twice moves nothing the second time."""
    told = store.open(claim)
    staged = spark._jvm.org.apache.commons.io.IOUtils.toString(told, "UTF-8")
    told.close()
    if not staged:
        raise FileExistsError(f"{claim} was made and left empty; remove it to deliver again")
    path = spark._jvm.org.apache.hadoop.fs.Path(staged)
    if store.exists(path):
        store.rename(path, target)
