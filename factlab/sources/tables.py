"""Parquet tables, inline dimension tables and named views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """Parquet scan with a declared schema, or with the one stored in the footer.

    Partition columns found in the directory names come on top of ``schema``.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Write Parquet, one directory per value of ``partition_by`` if given.

    Without a shuffle every task would open a file in every directory. The
    rebalance hint gathers each directory's rows first, and AQE splits the
    large ones and merges the small ones, so a month with a third of all rows
    is still written by many tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *map(F.col, partition_by))
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def dim_table(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """A small lookup table from rows given in the program."""
    return spark.createDataFrame(list(rows), schema)


def register(df: DataFrame, name: str) -> DataFrame:
    """Name a plan for SQL. Nothing is computed or kept; each use runs the plan."""
    df.createOrReplaceTempView(name)
    return df
