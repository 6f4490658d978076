"""Rows that are delivered more than once, counted once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.streaming.event_time import watermarked


def once_within(stream: DataFrame, time: str, delay: str, *keys: str) -> DataFrame:
    """The first delivery of each key; later ones are dropped, in the same batch or another.

    A key is remembered until the watermark is ``delay`` past its time, so state holds the keys of
    that span and not of all history. A copy that comes later still is older than the watermark and
    is dropped as late, like any row: choose ``delay`` above the longest way a first delivery takes.
    """
    return watermarked(stream, time, delay).dropDuplicatesWithinWatermark([*keys])
