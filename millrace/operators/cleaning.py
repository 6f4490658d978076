"""Parse raw sales tolerantly, explain what failed, and split accepted from rejected rows.

Every function maps a DataFrame to a DataFrame, starts no job and works the same on a stream.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import (
    first_failure,
    is_blank,
    lookup_key,
    parse_amount,
    parse_time,
    tidy_label,
)
from millrace.functions.fixed import BAD_AMOUNT, BAD_TIME, MALFORMED_LINE, MISSING_KEY
from millrace.sources.tables import CORRUPT


@dataclass(frozen=True)
class SalesColumns:
    """Where the cleaner reads and writes; the defaults are the usual sales layout."""

    key: str = "product_id"
    amount_raw: str = "amount_raw"
    time_raw: str = "sold_at_raw"
    amount: str = "amount"
    time: str = "sold_at"
    reason: str = "reject_reason"


def clean_sales(raw: DataFrame, names: SalesColumns = SalesColumns()) -> DataFrame:
    """Normalise the key in place, add parsed amount and time, and say why a row is unusable.

    Every input row stays, with its raw texts.
    """
    parsed = raw.withColumns(
        {
            names.key: lookup_key(F.col(names.key)),
            names.amount: parse_amount(F.col(names.amount_raw)),
            names.time: parse_time(F.col(names.time_raw)),
        }
    )
    return explain_rejects(
        parsed,
        [
            (is_blank(F.col(names.key)), MISSING_KEY),
            (F.col(names.amount).isNull(), BAD_AMOUNT),
            (F.col(names.time).isNull(), BAD_TIME),
        ],
        names.reason,
    )


def explain_rejects(
    frame: DataFrame, checks: Sequence[tuple[Column, str]], reason: str = "reject_reason"
) -> DataFrame:
    """Add the first failing check's text for each row."""
    return frame.withColumn(reason, first_failure(checks))


def explain_malformed(
    records: DataFrame, raw_line: str = "raw_line", reason: str = "reject_reason"
) -> DataFrame:
    """Reject what ``tables.parsed_lines`` could not read, with its line in ``raw_line``.

    This reason comes before one that is already there. Values read from part of a misfit are
    blanked: only the line tells what it held.
    """
    misfit = F.col(CORRUPT).isNotNull()
    earlier = F.col(reason) if reason in records.columns else F.lit(None).cast("string")
    values = [c for c in records.columns if c not in (CORRUPT, reason)]
    return records.select(
        *[F.when(~misfit, F.col(f"`{c}`")).alias(c) for c in values],
        F.col(CORRUPT).alias(raw_line),
        F.when(misfit, F.lit(MALFORMED_LINE)).otherwise(earlier).alias(reason),
    )


def accepted(cleaned: DataFrame, reason: str = "reject_reason") -> DataFrame:
    """Rows nothing speaks against. A key the lookup does not know is no reason to reject."""
    return cleaned.where(F.col(reason).isNull())


def rejected(cleaned: DataFrame, reason: str = "reject_reason") -> DataFrame:
    """Rows with a reason, raw values untouched, for audit."""
    return cleaned.where(F.col(reason).isNotNull())


def clean_lookup(raw: DataFrame, key: str = "product_id", label: str = "category") -> DataFrame:
    """Same rows, with the key normalised like the sales key and the label tidied."""
    return raw.select(
        lookup_key(F.col(key)).alias(key),
        tidy_label(F.col(label)).alias(label),
    )


def reshape_columns(
    frame: DataFrame,
    add: Mapping[str, Column] | None = None,
    rename: Mapping[str, str] | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """A derived projection: add, then rename, then drop. The rows and the input are unchanged."""
    return frame.withColumns(dict(add or {})).withColumnsRenamed(dict(rename or {})).drop(*drop)
