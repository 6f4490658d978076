"""Unbounded sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from millrace.sources.tables import parsed_lines


def read_stream(
    spark: SparkSession,
    source: str,
    path: str | None = None,
    schema: StructType | str | None = None,
    options: Mapping[str, object] | None = None,
) -> DataFrame:
    """Any streaming source by name: files (parquet, csv, json, orc, text), rate, kafka, ...

    File sources other than text need a schema. A file stream reads whole new files of one
    folder; for arrivals in sub-folders pass ``<landing>/*``.
    """
    reader = spark.readStream.format(source).options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def record_arrivals(spark: SparkSession, landing: str, schema: StructType | str, **how) -> DataFrame:
    """``tables.parsed_lines`` over the text files delivered to a landing folder."""
    return parsed_lines(arrivals(spark, landing, "value STRING", "text"), schema, **how)


def arrivals(
    spark: SparkSession,
    landing: str,
    schema: StructType | str,
    source: str = "parquet",
    options: Mapping[str, object] | None = None,
) -> DataFrame:
    """The stream of everything ``publish_arrival`` delivers to a landing folder."""
    return read_stream(spark, source, f"{landing}/*", schema, options)
