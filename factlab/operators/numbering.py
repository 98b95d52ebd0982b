"""Row numbers, ranks and tiles over a whole table, without one task that sees all of it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factlab.sources.scratch import fresh_path

_TASK_BITS = 33


def numbered(df: DataFrame, order: Sequence[str], name: str = "row_number") -> DataFrame:
    """``df`` with its row numbers (long, from 1) by the columns ``order`` as column ``name``.

    A column given as ``-column`` descends. NULL is the least value. Rows are range
    partitioned by ``order``, equal ones by where they were read, so that a value that a
    third of all rows share is still many tasks. Each task numbers its rows; the counts of
    the tasks before are added, one row for each task. The sorted rows are written to a
    fresh path and read back, since every job samples range bounds anew. This runs a job.
    """
    spark = df.sparkSession
    columns = [f"_c{i}" for i in range(len(df.columns))]
    place = dict(zip(df.columns, columns))
    rows = df.toDF(*columns).withColumn("_read", F.monotonically_increasing_id())
    sort = [F.desc(place[c[1:]]) if c[0] == "-" else F.asc(place[c]) for c in order]
    sort.append(F.asc("_read"))
    rows = rows.repartitionByRange(*sort).sortWithinPartitions(*sort)
    path = fresh_path(spark, "numbered")
    rows = rows.select(*columns, F.monotonically_increasing_id().alias("_at"))
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    rows = rows.withColumn("_task", F.shiftright("_at", _TASK_BITS))
    counts = rows.groupBy("_task").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("_task", F.coalesce(before, F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col("_at").bitwiseAND((1 << _TASK_BITS) - 1) + 1
    joined = rows.join(F.broadcast(counts), "_task")
    return joined.select(*columns, number.alias("_number")).toDF(*df.columns, name)


def ranked(
    df: DataFrame,
    order: Sequence[str],
    row_number: str = "row_number",
    rank: str | None = None,
    dense_rank: str | None = None,
    percent_rank: str | None = None,
    cume_dist: str | None = None,
    ntile: tuple[str, int] | None = None,
) -> DataFrame:
    """Row numbers of all rows of ``df`` as ``numbered`` gives them, and what else has a name.

    ``ntile`` is a name and the number of parts. Ranks of ties come from one aggregate by
    the order columns, whose groups are numbered in their turn for the dense rank, and a
    join that AQE splits where many rows tie.
    """
    rows = numbered(df, order, row_number)
    n = rows.count()
    out = [F.col(c) for c in (*df.columns, row_number)]
    if ntile:
        out.append(_tile(F.col(row_number), n, ntile[1]).alias(ntile[0]))
    if rank or dense_rank or percent_rank or cume_dist:
        keys = [c.removeprefix("-") for c in order]
        ties = rows.groupBy(*[F.col(c).alias(f"_tie{i}") for i, c in enumerate(keys)]).agg(
            F.min(row_number).alias("_rank"), F.count("*").alias("_ties")
        )
        ties = numbered(ties, ["_rank"], "_dense")
        same = reduce(and_, (rows[c].eqNullSafe(ties[f"_tie{i}"]) for i, c in enumerate(keys)))
        rows = rows.join(ties, same)
        first = F.col("_rank")
        share = (first - 1) / F.lit(n - 1.0) if n > 1 else F.lit(0.0)
        upto = (first + F.col("_ties") - 1) / F.lit(float(n or 1))
        for name, value in (
            (rank, first),
            (dense_rank, F.col("_dense")),
            (percent_rank, share),
            (cume_dist, upto),
        ):
            if name:
                out.append(value.alias(name))
    return rows.select(*out)


def _tile(number: Column, n: int, tiles: int) -> Column:
    """Of ``tiles`` parts of ``n`` rows the first n % tiles are one row longer."""
    size, longer = divmod(n, tiles)
    edge = longer * (size + 1)
    early = F.floor((number - 1) / (size + 1)) + 1
    late = F.floor((number - 1 - edge) / max(size, 1)) + 1 + longer
    return F.when(number <= edge, early).otherwise(late)
