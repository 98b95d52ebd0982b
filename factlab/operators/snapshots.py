"""What differs between two states of a table, as bags of rows: repeated rows count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _copies(old: DataFrame, new: DataFrame) -> DataFrame:
    """Each different row once, with its number of copies in both states.

    Grouping compares whole rows, so NULL equals NULL and no digest can collide. Copies
    are counted in the map tasks, so a row that a third of the table repeats is one
    partial row for each task.
    """
    if old.columns != new.columns:
        raise ValueError(f"columns differ: {old.columns} and {new.columns}")
    names = [f"_c{i}" for i in range(len(old.columns))]
    both = old.toDF(*names).withColumn("_new", F.lit(0))
    both = both.unionAll(new.toDF(*names).withColumn("_new", F.lit(1)))
    return both.groupBy(*names).agg(
        F.sum(1 - F.col("_new")).alias("_old_n"), F.sum("_new").alias("_new_n")
    )


def row_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """The rows of which one state has more copies than the other, once each.

    ``added`` and ``removed`` (long) tell how many copies ``new`` has more or fewer.
    """
    more = F.col("_new_n") - F.col("_old_n")
    found = _copies(old, new).where(more != 0)
    return found.select(
        *[c for c in found.columns if c not in ("_old_n", "_new_n")],
        F.greatest(more, F.lit(0)).alias("added"),
        F.greatest(-more, F.lit(0)).alias("removed"),
    ).toDF(*old.columns, "added", "removed")


def key_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Columns ``keys`` and ``change`` of the keys whose rows differ between the states.

    ``change`` is added (rows in ``new`` only), removed (in ``old`` only) or changed. A
    NULL key is a key. Keys meet after their rows were counted, combined again in the
    map tasks.
    """
    names = [f"_c{old.columns.index(key)}" for key in keys]
    differ = F.max(F.col("_old_n") != F.col("_new_n"))
    found = _copies(old, new).groupBy(*names).agg(
        F.sum("_old_n").alias("_old_n"), F.sum("_new_n").alias("_new_n"), differ.alias("_differ")
    )
    change = F.when(F.col("_old_n") == 0, "added").when(F.col("_new_n") == 0, "removed").otherwise("changed")
    return found.where("_differ").select(*names, change.alias("change")).toDF(*keys, "change")
