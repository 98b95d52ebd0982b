"""Exact distinct counts of whole numbers that are stored by part and merged later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_bitmaps(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Columns ``keys``, bucket, bits: the values of ``column`` (whole numbers) by key.

    A row holds the values of a stretch of 32,768 numbers as 4 KB of bits, set in the map
    tasks, so repeated values are never shuffled, and a hot key is one row for each task
    and stretch. This suits dense numbers; of sparse ones a row may hold a single value.
    NULL values count as none, and a key that has only those gets no row.
    """
    value = F.col(column).cast("long")
    rows = df.where(value.isNotNull()).select(*keys, value.alias("_value"))
    rows = rows.select(
        *keys,
        F.bitmap_bucket_number("_value").alias("bucket"),
        F.bitmap_bit_position("_value").alias("_bit"),
    )
    return rows.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("_bit").alias("bits"))


def merged_distinct(bitmaps: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Columns ``keys`` and ``name``: distinct values by ``keys``, from stored bitmaps.

    ``keys`` are columns or expressions named by ``withColumn`` of what ``bitmaps`` has;
    rows of one key and bucket are united, whichever days, files or runs they are from.
    Without keys there is one row, 0 for no bitmaps.
    """
    united = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    total = F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0))
    return united.groupBy(*keys).agg(total.alias(name))
