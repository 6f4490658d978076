"""Session settings the operators count on. All can be set on a running session."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()

SETTINGS = {
    # Sale times are UTC texts; parsing and calendar days follow the session zone.
    "spark.sql.session.timeZone": "UTC",
    # Coalesce small shuffle partitions, switch joins and split skewed ones at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming state on local disk with a change log, so it may outgrow executor memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Rows handed to Python at a time: a batch of long texts must fit in a worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # Merge a busy key's rows into sessions before they are shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings; sizes such as shuffle partitions stay as the cluster sets them."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def ship(spark: SparkSession) -> SparkSession:
    """Hand this package to the session's Python workers, once, wherever they run."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="millrace-"), "millrace")
        files = shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package))
        spark.sparkContext.addPyFile(files)
        _shipped.add(application)
    return spark
