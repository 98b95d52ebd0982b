"""Helpers that several operators share."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from factlab.sources.scratch import fresh_path, remove_path

#: White space of all word counts here: space, tab, newline, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    What reads it twice then sees the same rows, and a lost executor costs no
    more than the tasks it ran.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def stored_while(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``stored``, but removed at the end of the block, for what no result reads."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    yield df.sparkSession.read.schema(df.schema).parquet(path)
    remove_path(df.sparkSession, path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of what is written go when it is, not when the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of one batch, NULL read as empty."""
    return [text or "" for text in batch.column(column).to_pylist()]


def importable(spark: SparkSession) -> None:
    """Puts the folder of this package on the path of Python workers.

    Needed where it is neither installed nor sent with ``--py-files``; a folder that an
    executor does not have is no error.
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        parts = [x for x in (root, known) if x]
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(parts)


def by_place(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns named by place, so that no name of theirs can clash."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def place_of(docs: DataFrame, column: str) -> str:
    """The name that ``by_place`` gives a column."""
    return f"c{docs.columns.index(column)}"
