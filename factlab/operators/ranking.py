"""Best rows overall and best rows per group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper limit, a power of two, of the rows broadcast to prune candidates for rank 1.
SLOTS = 65_536


def top_k(
    df: DataFrame, score: Column, score_as: str, k: int, tie_break: Sequence[str]
) -> DataFrame:
    """The ``k`` rows of highest score, equal scores in ascending ``tie_break`` order.

    Spark keeps ``k`` rows per task and merges those; there is no full sort.
    """
    return df.withColumn(score_as, score).orderBy(F.desc(score_as), *tie_break).limit(k)


def preview(df: DataFrame, rows: int, order: Sequence[str | Column]) -> DataFrame:
    """The first ``rows`` rows in ``order``, found without sorting the rest."""
    return df.orderBy(*order).limit(rows)


def top_ranked(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rank_as: str = "rank",
    ties: Literal["all", "one"] = "all",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The rows of rank 1 in each group, by ``order`` descending with NULL last.

    ``ties="all"`` keeps every row equal to the best one, as ``rank() = 1`` does. It
    reads ``df`` twice, the first time only its key and order columns.
    ``ties="one"`` keeps a single row: the highest by ``tie_break`` and, where that
    leaves a choice, by the remaining columns.
    """
    if ties == "one":
        return _single_winner(df, keys, [*order, *tie_break], rank_as)
    if ties == "all":
        return _all_winners(df, keys, order, rank_as)
    raise ValueError(f"ties must be 'all' or 'one', not {ties!r}")


def _single_winner(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rank_as: str
) -> DataFrame:
    # The maximum of a struct sorts its input, so only the rows of each group's greatest
    # first value get there; the further columns take no round of their own.
    rows = _greatest(df, keys, order[:1])
    others = [*order, *(name for name in df.columns if name not in (*keys, *order))]
    winner = F.max(F.struct(*dict.fromkeys(others))).alias("_winner")
    columns = [F.col(name if name in keys else f"_winner.{name}") for name in df.columns]
    return rows.groupBy(*keys).agg(winner).select(*columns, F.lit(1).alias(rank_as))


def _all_winners(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rank_as: str
) -> DataFrame:
    return _greatest(df, keys, order).withColumn(rank_as, F.lit(1))


def _greatest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    # A rank() window would sort every row and bring all rows tied at the top of
    # a hot group into one task, and the maximum of a struct would sort all rows in
    # the map tasks. Instead each group's best value of the first column comes from
    # a hash aggregate, and rows are matched with it in a join on group and value,
    # which AQE splits where many rows tie; then the next column among those left.
    rows = df
    for i, name in enumerate(order):
        best = rows.groupBy(*(F.col(key).alias(f"_best_{key}") for key in keys)).agg(
            F.max(name).alias("_best")
        )
        if i == 0:
            rows = _drop_hopeless(rows, best, keys, name)
        same = reduce(and_, (rows[key].eqNullSafe(best[f"_best_{key}"]) for key in keys))
        # NULL stands last, so it is the best only where a group has nothing else.
        same = same & rows[name].eqNullSafe(best["_best"])
        rows = rows.join(best, same).select(*df.columns)
    return rows


def _drop_hopeless(
    df: DataFrame, best: DataFrame, keys: Sequence[str], first: str
) -> DataFrame:
    # Groups hash into SLOTS slots, and the lowest of a slot's best values bounds
    # what a winner in it must reach. That table has at most SLOTS rows however
    # many groups there are, so it can be broadcast, and rows below the bound
    # never reach the join's shuffle. A slot with a best value of NULL bounds nothing, and
    # the more groups there are beyond SLOTS, the less a bound leaves out.
    def slot(names: Sequence[str]) -> Column:
        return F.xxhash64(*names).bitwiseAND(SLOTS - 1)

    value = F.col("_best")
    bounds = best.groupBy(slot([f"_best_{name}" for name in keys]).alias("_slot")).agg(
        F.when(F.count(F.lit(1)) == F.count(value), F.min(value)).alias("_bound")
    )
    return (
        df.withColumn("_slot", slot(keys))
        .join(F.broadcast(bounds), "_slot")
        .filter(F.col("_bound").isNull() | (F.col(first) >= F.col("_bound")))
        .drop("_slot", "_bound")
    )
