"""Distinct counts and quantiles within stated errors, from sketches stored by part.

A sketch is a few kilobytes whatever the rows behind it, is made in the map tasks, and
merges with others of its kind: store one for each day, merge them for any month later.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Base 2 logarithm of the registers of a distinct count.
REGISTERS = 12
#: Values that a quantile sketch keeps at each of its levels.
SIZE = 400


def distinct_sketches(
    df: DataFrame, keys: Sequence[str], column: str, registers: int = REGISTERS
) -> DataFrame:
    """Columns ``keys``, n (rows with a value), sketch: the values of ``column`` by key.

    NULL values count as none; a key that has only those has a sketch of nothing.
    """
    return df.groupBy(*keys).agg(
        F.count(column).alias("n"), F.hll_sketch_agg(column, registers).alias("sketch")
    )


def merged_distinct_estimate(sketches: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Columns ``keys``, n and ``name``: about as many distinct values as ``keys`` have.

    ``keys`` are columns of ``sketches``, often coarser than those it was made by. With 2 ** r
    registers the standard error is 1.04 / 2 ** (r / 2) of the count (1.6 % for 12); counts
    below a sixteenth of the registers are exact but for equal hashes.
    """
    united = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return sketches.groupBy(*keys).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(united, F.lit(0)).alias(name)
    )


def quantile_sketches(
    df: DataFrame, keys: Sequence[str], column: str, size: int = SIZE
) -> DataFrame:
    """Columns ``keys``, n, sketch: the spread of ``column``, read as double, by key.

    NULL and NaN count as no value; a key that has only those gets no row.
    """
    value = F.col(column).cast("double")
    rows = df.where(value.isNotNull() & ~F.isnan(value)).select(*keys, value.alias("_value"))
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"), F.kll_sketch_agg_double("_value", size).alias("sketch")
    )


def merged_quantiles(
    sketches: DataFrame, keys: Sequence[str], quantiles: Mapping[str, float]
) -> DataFrame:
    """Columns ``keys``, n and one for each of ``quantiles`` (name: share from 0 to 1).

    The value given has a true rank within about 2.7 / size of the share asked for (0.7 % for
    400); of fewer values than the size it is an exact quantile, a value of the data. Larger
    sketches draw which values to keep, so another run may give a neighbouring value.
    """
    merged = sketches.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("_merged")
    )
    values = {
        name: F.kll_sketch_get_quantile_double("_merged", F.lit(float(share)))
        for name, share in quantiles.items()
    }
    return merged.where(F.col("n") > 0).withColumns(values).drop("_merged")


def error_bound(registers: int = REGISTERS, deviations: float = 3.0) -> float:
    """The share of the count that an estimate is off by at most, but for rare cases."""
    return deviations * 1.04 / 2 ** (registers / 2)
