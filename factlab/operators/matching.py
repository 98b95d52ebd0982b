"""Rows with or without a partner, and outer joins, where keys are NULL or hot.

Keys are pairs (column of the left side, column of the right side). NULL keys match
nothing, but their rows would all be shuffled to one task; here they are spread by the
number of the partition they were read in, which a task that runs again finds unchanged.
Whole numbers of any width may meet, and both widths of floating point; keys of other types
have to be of the same one. NaN equals NaN, as in Spark's joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Keys = Sequence[tuple[str, str]]


def exists_in(left: DataFrame, right: DataFrame, on: Keys) -> DataFrame:
    """Rows of ``left`` whose keys stand in ``right``, each once (SQL ``EXISTS`` and ``IN``)."""
    return _matched(left, right, on, "left_semi")


def not_exists_in(left: DataFrame, right: DataFrame, on: Keys) -> DataFrame:
    """Rows of ``left`` without a partner in ``right``, those with a NULL key included.

    This is SQL's ``NOT EXISTS``: what is NULL equals nothing.
    """
    return _matched(left, right, on, "left_anti")


def not_in(left: DataFrame, right: DataFrame, column: str, other: str) -> DataFrame:
    """Rows of ``left`` for which SQL's ``column NOT IN (select other from right)`` is true.

    If ``right`` is empty these are all rows. If it holds a NULL there are none, as the NULL
    might be any value; else a row with a NULL in ``column`` is left out. Spark runs the SQL
    form as a nested loop once ``right`` is too large to broadcast. Here two counts of
    ``right``, found as one row, decide which rows can qualify, and an equi-join does the rest.
    """
    known = right.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(other).isNull()).alias("nulls")
    )
    empty = known.select(F.col("rows") == 0).scalar()
    certain = known.select(F.col("nulls") == 0).scalar()
    possible = left.where(empty | (certain & F.col(column).isNotNull()))
    return not_exists_in(possible, right, [(column, other)])


def outer_join(left: DataFrame, right: DataFrame, on: Keys, how: str = "left") -> DataFrame:
    """All columns of both sides, whose names have to differ; ``how`` is left or full.

    Rows of ``left`` without a partner have NULLs on the right. ``full`` adds the rows of
    ``right`` without one. AQE splits a hot key of ``left`` in a left join and splits nothing
    in a full one, so the full join is a left join and an anti join.
    """
    if how not in ("left", "full"):
        raise ValueError(f"how is left or full, not {how}")
    if clash := set(left.columns) & set(right.columns):
        raise ValueError(f"both sides have {', '.join(sorted(clash))}")
    one, two = _digested(left, right, on)
    same = [F.col(a) == F.col(b) for a, b in [*on, ("_left_digest", "_right_digest")]]
    joined = one.join(two, reduce(and_, same), "left").drop("_left_digest", "_right_digest")
    if how == "left":
        return joined
    rest = not_exists_in(right, left, [(b, a) for a, b in on])
    return joined.unionByName(rest, allowMissingColumns=True)


def _matched(left: DataFrame, right: DataFrame, on: Keys, how: str) -> DataFrame:
    # The keys of ``right`` are made distinct in the map tasks, so a hot one is one row. The
    # join compares a digest too: an aggregate by the keys alone would lend the join its own
    # shuffle, and AQE splits hot keys of ``left`` only in shuffles made for the join.
    names = [f"_key{i}" for i in range(len(on))]
    keys = right.select(*[F.col(b).alias(name) for name, (_, b) in zip(names, on)])
    pairs = [(a, name) for name, (a, _) in zip(names, on)]
    known = reduce(and_, (F.col(name).isNotNull() for name in names))
    rows, keys = _digested(left, keys.where(known).distinct(), pairs)
    same = [F.col(a) == F.col(b) for a, b in [*pairs, ("_left_digest", "_right_digest")]]
    return rows.join(keys, reduce(and_, same), how).drop("_left_digest")


def _digested(left: DataFrame, right: DataFrame, on: Keys) -> tuple[DataFrame, DataFrame]:
    """Both sides with a digest of their keys; that of a NULL key on the left is a partition."""
    ones = [_family(left.schema[a].dataType) for a, _ in on]
    twos = [_family(right.schema[b].dataType) for _, b in on]
    if ones != twos:
        raise ValueError(f"keys of different types, cast one side: {ones} and {twos}")
    lone = reduce(or_, (F.col(a).isNull() for a, _ in on))
    place = F.spark_partition_id().cast("long")
    first = F.when(lone, place).otherwise(_digest([a for a, _ in on], ones))
    second = _digest([b for _, b in on], twos)
    return left.withColumn("_left_digest", first), right.withColumn("_right_digest", second)


def _family(kind: T.DataType) -> str:
    """Types of one family compare by value; others only with themselves."""
    if isinstance(kind, T.IntegralType):
        return "long"
    return "double" if isinstance(kind, T.FloatType | T.DoubleType) else kind.simpleString()


def _digest(columns: Sequence[str], families: Sequence[str]) -> Column:
    """Equal for equal keys: -0.0 equals 0.0, and whole numbers of any width each other."""
    values = []
    for column, family in zip(columns, families):
        value = F.col(column).cast(family)
        values.append(value + F.lit(0.0) if family == "double" else value)
    return F.xxhash64(*values)
