"""Column expressions. Each helper returns a Column, so Catalyst sees all of it; none is a UDF."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.fixed import AMOUNT_TYPE, TIMESTAMP_PATTERN, UNMAPPED


def lookup_key(column: Column) -> Column:
    """Join keys compare without surrounding spaces and without case."""
    return F.upper(F.trim(column))


def tidy_label(column: Column) -> Column:
    return F.lower(F.trim(column))


def is_blank(column: Column) -> Column:
    return column.isNull() | (column == F.lit(""))


def parse_amount(column: Column, decimal_type: str = AMOUNT_TYPE) -> Column:
    """Exact decimal, or null where the text is no number; never zero."""
    return column.try_cast(decimal_type)


def parse_time(column: Column, pattern: str = TIMESTAMP_PATTERN) -> Column:
    """Timestamp in the session time zone, or null where the text does not fit the pattern."""
    return F.try_to_timestamp(column, F.lit(pattern))


def first_failure(checks: Sequence[tuple[Column, str]]) -> Column:
    """Text of the first check that holds, in the order given; null when none does."""
    return F.coalesce(*[F.when(failed, F.lit(text)) for failed, text in checks])


def or_else(column: Column, label: str = UNMAPPED) -> Column:
    return F.coalesce(column, F.lit(label))


def pieces(column: Column, separator: str) -> Column:
    """One row per piece of a delimited text. The separator is literal: a pipe needs no escape."""
    return F.explode(F.split(column, re.escape(separator)))
