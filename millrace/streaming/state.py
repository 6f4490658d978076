"""The state that a checkpoint holds, as tables. Nothing is run or changed by reading it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per stateful step of a query: its number, name, stores, partitions and batches."""
    return spark.read.format("state-metadata").load(checkpoint)


def state_rows(
    spark: SparkSession,
    checkpoint: str,
    batch: int | None = None,
    operator: int = 0,
    **options: object,
) -> DataFrame:
    """Keys and values of a stateful step after a batch (by default the last), as ``key``, ``value``.

    ``options`` go to Spark's reader, such as ``stateVarName`` for one variable of a custom operator.
    Read in parallel, a task per state partition. A batch older than those the checkpoint keeps is
    refused.
    """
    reader = spark.read.format("statestore").option("operatorId", operator).options(**options)
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint)


def flat_state(rows: DataFrame) -> DataFrame:
    """The fields of ``key`` and ``value`` side by side; those of the value are called ``state_*``."""
    named = [F.col(f"key.`{f.name}`").alias(f.name) for f in rows.schema["key"].dataType]
    held = [F.col(f"value.`{f.name}`").alias(f"state_{f.name}") for f in rows.schema["value"].dataType]
    return rows.select(*named, *held)


def state_changes(
    spark: SparkSession, checkpoint: str, first: int, last: int, operator: int = 0, **options: object
) -> DataFrame:
    """What each batch from ``first`` to ``last`` wrote to or removed from the state.

    Needs the change log that ``session.prepare`` turns on.
    """
    reader = spark.read.format("statestore").option("operatorId", operator).options(**options)
    reader = reader.option("readChangeFeed", True).option("changeStartBatchId", first)
    return reader.option("changeEndBatchId", last).load(checkpoint)
