"""Joins on time: the last earlier row of a key, and rows whose intervals overlap."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Bucket = Callable[[str], Column]


def by_day(name: str) -> Column:
    """The day number of a date or timestamp."""
    return F.unix_date(F.to_date(name)).cast("long")


def by_days(days: int) -> Bucket:
    """Numbers of stretches of ``days`` days."""
    return lambda name: F.floor(by_day(name) / days)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    left_time: str,
    right_time: str,
    columns: dict[str, str],
    bucket: Bucket = by_day,
) -> DataFrame:
    """Every row of ``left`` with ``columns`` (name to new name) of its last ``right`` row.

    That is the row of equal ``keys`` (left, right) with the greatest time not after the
    left row's; of equal times the greatest by ``columns`` in their order. Without one,
    and where a key or time is NULL, the new columns are NULL. NULL keys match nothing.

    ``bucket`` maps times to whole numbers that never fall as time grows. Rows meet by key
    and bucket, so a hot key is as many tasks as it has buckets, and both sides are
    shuffled once. What a bucket inherits is its key's last right row of the buckets
    before: one row for each key and bucket takes part in finding that.
    """
    lefts, names = [k for k, _ in keys], [f"_c{i}" for i in range(len(left.columns))]
    key_names = [f"_k{i}" for i in range(len(keys))]
    meet = [*key_names, "_bucket"]
    value = F.struct(*[F.col(name) for name in columns])
    given = right.where(reduce(and_, (F.col(c).isNotNull() for c in (*[k for _, k in keys], right_time))))
    given = given.select(
        *[F.col(k).alias(name) for (_, k), name in zip(keys, key_names)],
        bucket(right_time).alias("_bucket"),
        F.col(right_time).alias("_time"),
        value.alias("_value"),
    )
    asking = left.select(
        *[F.col(k).alias(name) for k, name in zip(lefts, key_names)],
        bucket(left_time).alias("_bucket"),
        F.col(left_time).alias("_time"),
        F.struct(*[F.col(c).alias(name) for c, name in zip(left.columns, names)]).alias("_left"),
    )
    # What each bucket hands on, and which buckets have rows that may inherit it.
    last = given.groupBy(*meet).agg(F.max(F.struct("_time", "_value")).alias("_last"))
    wanted = asking.select(*meet).distinct().withColumn("_last", F.lit(None).cast(last.schema["_last"].dataType))
    ends = last.unionByName(wanted).groupBy(*meet).agg(F.max("_last").alias("_last"))
    earlier = Window.partitionBy(*key_names).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_last", F.last("_last", ignorenulls=True).over(earlier)).where("_last is not null")
    carried = carried.select(*meet, F.col("_last._time").alias("_time"), F.col("_last._value").alias("_value"))

    rows = given.withColumn("_side", F.lit(1)).unionByName(carried.withColumn("_side", F.lit(0)))
    rows = rows.unionByName(asking.withColumn("_side", F.lit(2)), allowMissingColumns=True)
    order = Window.partitionBy(*meet).orderBy("_time", "_side", "_value")
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_value", F.last("_value", ignorenulls=True).over(before)).where("_side = 2")
    known = reduce(and_, (F.col(c).isNotNull() for c in (*key_names, "_time")))
    found = [F.when(known, F.col(f"_value.{c}")).alias(new) for c, new in columns.items()]
    return rows.select(*[F.col(f"_left.{n}").alias(c) for n, c in zip(names, left.columns)], *found)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    bucket: Bucket = by_day,
) -> DataFrame:
    """Pairs of rows of equal ``keys`` whose closed intervals (first, last column) overlap.

    A point in time is an interval of one column twice. Each side has a row for every
    bucket its interval touches, and meets the other by key and bucket, an equi-join that
    AQE splits where a key and bucket are hot; the pair is given by the first bucket they
    share, so once. ``bucket`` never falls as time grows; one about as long as a usual
    interval keeps the rows few. Columns of both sides must have different names. NULL
    keys and ends, and intervals that end before they start, match nothing.
    """

    def touched(df: DataFrame, span: tuple[str, str], mark: str, names: Sequence[str]) -> DataFrame:
        whole = reduce(and_, (F.col(c).isNotNull() for c in names))
        rows = df.where(whole & (F.col(span[0]) <= F.col(span[1])))
        rows = rows.withColumn(f"_{mark}", bucket(span[0]))
        return rows.withColumn(f"_{mark}_at", F.explode(F.sequence(F.col(f"_{mark}"), bucket(span[1]))))

    one = touched(left, left_span, "left", [k for k, _ in keys])
    two = touched(right, right_span, "right", [k for _, k in keys])
    same = reduce(and_, (one[a] == two[b] for a, b in keys)) & (one["_left_at"] == two["_right_at"])
    pairs = one.join(two, same).where(
        (F.col("_left_at") == F.greatest("_left", "_right"))
        & (F.col(left_span[0]) <= F.col(right_span[1]))
        & (F.col(right_span[0]) <= F.col(left_span[1]))
    )
    return pairs.select(*left.columns, *right.columns)
