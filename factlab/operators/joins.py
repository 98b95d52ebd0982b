"""Inner equi-joins of a fact table with lookup tables and with its own groups.

AQE splits a hot key's rows among tasks if the shuffle was put there for the
join itself. It leaves alone the output of an explicit ``repartition`` or of an
aggregate that already has the join's partitioning; the joins below see to those cases.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str,
    columns: Sequence[str] | None = None,
    fixed_size: bool = False,
) -> DataFrame:
    """Enrich ``fact`` from a lookup table; rows without a match are dropped.

    ``fixed_size`` declares that ``dim`` does not grow with the data (rows
    listed in the program, nations, calendars): it is then broadcast whatever
    the session's threshold. Otherwise Spark compares its size with
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides beyond it.
    """
    joined = fact.join(F.broadcast(dim) if fixed_size else dim, on, "inner")
    return joined if columns is None else joined.select(*columns)


def merge_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str,
    columns: Sequence[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Sort-merge join of ``fact`` with a large ``dim``.

    By default Spark sizes the shuffles and splits hot keys. ``partitions``
    fixes the number of partitions, for output in a known number of files;
    hot keys are then spread by a salt.
    """
    if partitions is None:
        joined = fact.join(dim.hint("merge"), on, "inner")
    else:
        joined = _aligned_join(fact, dim, on, partitions)
    return joined if columns is None else joined.select(*columns)


def _aligned_join(fact: DataFrame, dim: DataFrame, on: str, partitions: int) -> DataFrame:
    # A key with more rows than an even partition is hot. Fewer than
    # ``partitions`` keys can be, which bounds the broadcast table of them and
    # the copies of their rows in ``dim``.
    fact = fact.filter(F.col(on).isNotNull())
    counts = fact.groupBy(on).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    hot = counts.filter(F.col("_rows") * partitions > total).select(on, F.lit(True).alias("_hot"))
    # The number of the input partition is the same when a lost task runs again,
    # which a random number or a row number is not.
    spread = F.pmod(F.spark_partition_id(), F.lit(partitions))
    salted_fact = (
        fact.withColumn("_spread", spread)
        .join(F.broadcast(hot), on, "left")
        .withColumn("_salt", F.when(F.col("_hot"), F.col("_spread")).otherwise(F.lit(0)))
        .drop("_spread", "_hot")
        .repartition(partitions, on, "_salt")
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(partitions - 1)))
    salted_dim = (
        dim.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", F.explode(F.coalesce(copies, F.array(F.lit(0)))))
        .drop("_hot")
    )
    joined = salted_fact.join(salted_dim.hint("merge"), [on, "_salt"], "inner").drop("_salt")
    # Spark widens a shuffle below the session's width again; this needs no further one.
    return joined.coalesce(partitions)


def join_to_groups(
    rows: DataFrame, groups: DataFrame, on: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows whose group is in ``groups``, an aggregate by ``on``, with its columns.

    The aggregate already is partitioned by ``on``, and the join would take that
    as it is. Joining on a digest of the key as well gives both sides a shuffle
    of the join's own; the extra one moves groups, not rows. NULL keys are
    removed from ``rows`` only, and the keys compared NULL-safe: a filter on the
    aggregate's key would be pushed below it, and its shuffle could then not be
    shared with other readers of the aggregate.
    """
    left = rows.filter(F.col(on).isNotNull()).withColumn("_digest", F.xxhash64(on))
    right = groups.withColumn("_group_digest", F.xxhash64(on)).withColumnRenamed(on, "_group")
    same = (F.col("_digest") == F.col("_group_digest")) & F.col(on).eqNullSafe(F.col("_group"))
    joined = left.join(right, same, "inner").drop("_digest", "_group_digest", "_group")
    return joined if columns is None else joined.select(*columns)
