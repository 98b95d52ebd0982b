"""Sessions: stretches of a key's rows without a longer gap between neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sessions(df: DataFrame, keys: Sequence[str], time: str, gap_seconds: int) -> DataFrame:
    """Columns ``keys``, session (number from 1 within the key), first_at, last_at, n (rows).

    Rows of a key that lie up to ``gap_seconds`` apart are in one session. Rows of NULL
    time are in none; a NULL key is a key of its own. ``time`` is a timestamp.

    Rows of one stretch of ``gap_seconds`` are in one session whatever else there is, so
    they are combined first, in the map tasks. What is sorted by key is one row for each
    stretch that has any: for a hot key as many as time has stretches, not as it has rows.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.where(F.col(time).isNotNull()).select(
        *[F.col(key).alias(name) for key, name in zip(keys, names)], F.col(time).alias("_at")
    )
    # From a time before all others, so that whole seconds are cut towards it.
    since = F.col("_at") - F.lit("0001-01-01 00:00:00").cast(rows.schema["_at"].dataType)
    stretch = F.floor(since.cast("interval second").cast("long") / F.lit(gap_seconds))
    parts = rows.groupBy(*names, stretch.alias("_stretch")).agg(
        F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.count("*").alias("_n")
    )
    along = Window.partitionBy(*names).orderBy("_stretch")
    limit = F.lag("_last").over(along) + F.expr(f"interval {gap_seconds} seconds")
    parts = parts.withColumn("_new", F.coalesce((F.col("_first") > limit).cast("long"), F.lit(1)))
    parts = parts.withColumn("_session", F.sum("_new").over(along))
    found = parts.groupBy(*names, "_session").agg(
        F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.sum("_n").alias("_n")
    )
    return found.toDF(*keys, "session", "first_at", "last_at", "n")
