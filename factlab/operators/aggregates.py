"""Grouped statistics. Every aggregate is combined inside the map tasks before the
shuffle, so a key with a third of all rows sends one partial row per task."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Literal, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factlab.functions import day_of, one_of

Nulls = Literal["skip", "zero"]


class Stat(NamedTuple):
    """One output column: ``how`` is mean, sum or std of ``column``, rounded to ``digits``."""

    name: str
    how: Literal["mean", "sum", "std"]
    column: str
    digits: int | None = None


def rounded(value: Column, digits: int) -> Column:
    """``value`` half up, its last bits left out first: they depend on the order of a sum."""
    return F.round(F.round(value, digits + 8), digits)


def _stat_column(stat: Stat, nulls: Nulls, ddof: int) -> Column:
    if nulls not in ("skip", "zero"):
        raise ValueError(f"nulls must be 'skip' or 'zero', not {nulls!r}")
    if ddof not in (0, 1):
        raise ValueError(f"ddof must be 0 (population) or 1 (sample), not {ddof!r}")
    value = F.col(stat.column)
    if nulls == "zero":
        value = F.coalesce(value, F.lit(0))
    std = F.stddev_samp if ddof == 1 else F.stddev_pop
    result = {"mean": F.avg, "sum": F.sum, "std": std}[stat.how](value)
    if stat.digits is not None:
        result = rounded(result, stat.digits)
    return result.alias(stat.name)


def grouped_stats(
    df: DataFrame,
    keys: Sequence[str],
    stats: Sequence[Stat],
    count_as: str = "n",
    min_rows: int = 0,
    nulls: Nulls = "skip",
    ddof: int = 1,
) -> DataFrame:
    """Row count and ``stats`` per group, for groups of at least ``min_rows`` rows.

    ``nulls="skip"`` leaves NULL values out of mean, sum and deviation;
    ``"zero"`` counts them as 0. ``ddof`` picks sample (1) or population (0) deviation.
    """
    columns = [_stat_column(stat, nulls, ddof) for stat in stats]
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as), *columns)
    return groups.filter(F.col(count_as) >= min_rows) if min_rows else groups


def grouped_levels(
    df: DataFrame,
    keys: Sequence[str],
    levels: Literal["cube", "rollup"] | Sequence[Sequence[str]],
    stats: Sequence[Stat],
    level_as: str = "level",
    count_as: str = "n",
    nulls: Nulls = "skip",
    ddof: int = 1,
) -> DataFrame:
    """``grouped_stats`` for several sets of ``keys`` in one scan and one shuffle.

    ``levels`` is every set (cube), every prefix (rollup), or the sets themselves. Keys that
    a set leaves out are NULL; ``level_as`` has a bit for each of them, the first key the
    highest, which tells such totals from groups of a NULL key.
    """
    columns = [F.grouping_id().cast("long").alias(level_as), F.count(F.lit(1)).alias(count_as)]
    columns += [_stat_column(stat, nulls, ddof) for stat in stats]
    if levels == "cube":
        return df.cube(*keys).agg(*columns)
    if levels == "rollup":
        return df.rollup(*keys).agg(*columns)
    sets = [[F.col(key) for key in chosen] for chosen in levels]
    return df.groupingSets(sets, *keys).agg(*columns)


def global_mean(df: DataFrame, value: str, mean_as: str = "mean") -> DataFrame:
    """One row: the mean of ``value`` over the rows that have one."""
    return df.agg(F.avg(value).alias(mean_as))


def daily_counts(df: DataFrame, key: str, when: str, day_as: str, count_as: str) -> DataFrame:
    """Rows per key and day; rows without a day are left out."""
    days = df.select(key, day_of(df, when).alias(day_as))
    return (
        days.filter(F.col(day_as).isNotNull())
        .groupBy(key, day_as)
        .agg(F.count(F.lit(1)).alias(count_as))
    )


def period_summary(
    df: DataFrame,
    keys: Sequence[str],
    stats: Sequence[Stat],
    years: Iterable[int],
    count_as: str = "n",
    nulls: Nulls = "skip",
) -> DataFrame:
    """Statistics per period for the given years, in period order.

    ``keys`` starts with the year column. Where that is a partition column of
    the stored table, only the directories of these years are opened.
    """
    chosen = df.filter(one_of(keys[0], sorted(set(years))))
    return grouped_stats(chosen, keys, stats, count_as, nulls=nulls).orderBy(*keys)


def above_global_mean(
    df: DataFrame,
    key: str,
    value: str,
    mean_as: str,
    count_as: str = "n",
    min_rows: int = 1,
    digits: int = 4,
) -> DataFrame:
    """Groups of ``min_rows`` or more valued rows whose rounded mean exceeds the overall mean.

    The overall mean is taken from the per-group sums and counts, not from the
    rows, so group means and overall mean share one scan and one shuffle.
    """
    groups = (
        df.filter(F.col(value).isNotNull())
        .groupBy(key)
        .agg(
            F.sum(F.col(value).cast("double")).alias("_sum"),
            F.count(F.lit(1)).alias(count_as),
        )
    )
    overall = groups.agg(F.sum("_sum") / F.sum(count_as)).scalar()
    mean = rounded(F.col("_sum") / F.col(count_as), digits)
    return (
        groups.filter(F.col(count_as) >= min_rows)
        .select(key, mean.alias(mean_as), count_as)
        .filter(F.col(mean_as) > overall)
    )
