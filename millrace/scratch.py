"""Where a run keeps what it must write and read again: checkpoints, landings, round trips."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: on a cluster, executors
    on other machines could not see one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="millrace-")
    return _local_roots[context.applicationId]


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A path nothing was written to yet; it is created by the first write."""
    return f"{shared_folder(spark)}/millrace/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(frame: DataFrame, purpose: str = "cut") -> DataFrame:
    """Write a frame to the shared folder and go on from the files.

    A lost executor then costs a re-read, not a recomputation of everything upstream.
    """
    folder = fresh_folder(frame.sparkSession, purpose)
    frame.write.mode("errorifexists").parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def discard(frame: DataFrame) -> None:
    """Delete the files of a frame that ``cut_lineage`` gave and that nothing will read again."""
    spark = frame.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
        if "/millrace/" not in folder:
            raise ValueError(f"{folder} is no intermediate result")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
