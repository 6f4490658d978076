"""Bounded sources. Schemas come with the file or are declared; nothing is inferred from data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

CORRUPT = "_corrupt_record"


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header row and a declared schema; an empty field is null, spaces are kept."""
    return spark.read.option("header", True).schema(schema).csv(path)


def parsed_lines(
    lines: DataFrame,
    schema: StructType | str,
    source: str = "csv",
    options: Mapping[str, object] | None = None,
    header: str | None = None,
) -> DataFrame:
    """Typed rows out of lines of CSV or JSON (column ``value``), batch or stream.

    A line that does not fit is kept whole in ``CORRUPT``: one with too few or too many fields, a value
    that is not of its type, or broken syntax. ``cleaning.explain_malformed`` makes it a rejected row.
    Blank lines, and lines equal to ``header``, are no rows. Lines are parsed whole whichever columns are
    read: a reader that parses only those asked for would find fewer misfits the less is asked.
    """
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = StructType([*declared.fields]).add(CORRUPT, StringType())
    told = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **dict(options or {})}
    parse = {"csv": F.from_csv, "json": F.from_json}[source]
    value = F.col("value")
    rows = lines.where((F.trim(value) != "") & (value != (header or "")))
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole)
    rows = rows.select(value, parse(value, kind, told).alias("row"))
    misfit = F.when(F.col("row").isNull(), value).otherwise(F.col("row")[CORRUPT])
    return rows.select(*[F.col("row")[f.name].alias(f.name) for f in declared], misfit.alias(CORRUPT))


def read_records(spark: SparkSession, path: str, schema: StructType | str, **how) -> DataFrame:
    """The rows and misfits of text files; ``how`` as in ``parsed_lines``."""
    return parsed_lines(spark.read.text(path), schema, **how)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, in ``value``."""
    return spark.read.text(path)


def numbered(spark: SparkSession, n: int) -> DataFrame:
    """Ids 0 to n - 1, generated in the tasks."""
    return spark.range(n)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A short list of rows from the program text: bands, calendars of holidays, fixtures."""
    return spark.createDataFrame(list(rows), schema)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
