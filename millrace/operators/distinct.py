"""Exact distinct counts that can be stored and merged: bitmaps of ids, in buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_bitmaps(frame: DataFrame, id_col: str, *keys: str) -> DataFrame:
    """Per group of ``keys`` and bucket of ids: ``bucket`` and ``bitmap``, a bit for each id that occurs.

    Ids are whole numbers; a bucket holds 32,768 of them in 4 kB, so dense ids are cheap and a group
    of any size is many small rows. Null ids count for nothing; keys may be null.
    """
    known = frame.where(F.col(id_col).isNotNull())
    bucket = F.bitmap_bucket_number(F.col(id_col)).alias("bucket")
    return known.groupBy(*keys, bucket).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(id_col))).alias("bitmap")
    )


def merged_bitmaps(stored: DataFrame, *keys: str) -> DataFrame:
    """Stored bitmaps rolled up to coarser keys; none of the rows behind them is read again."""
    return stored.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_ids(bitmaps: DataFrame, *keys: str, label: str = "distinct_ids") -> DataFrame:
    """How many ids each group has."""
    return merged_bitmaps(bitmaps, *keys).groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).alias(label))
