"""Raw CSV with quoted multi-line text, and the job that turns it into a typed table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Literal

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from factlab.functions import add_period, text_to_boolean
from factlab.sources.split_csv import read_csv_split
from factlab.sources.tables import write_table

Tasks = Literal["files", "blocks", "lines"]


def _reader(spark: SparkSession, multi_line: bool) -> DataFrameReader:
    # enforceSchema=false compares every file's header with the columns and
    # fails on a file in another order, which would otherwise be read by position.
    return (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("enforceSchema", False)
    )


def read_csv_raw(spark: SparkSession, path: str, tasks: Tasks = "files") -> DataFrame:
    """CSV with a header line, every column text.

    A quoted newline hides where records start, so by default one file is one
    task: deliver the data as many files. ``tasks="blocks"`` divides large files
    at the price of shuffling their lines (see ``split_csv``).
    ``tasks="lines"`` is for data without quoted newlines, which needs neither.
    """
    if tasks == "files":
        return _reader(spark, multi_line=True).csv(path)
    if tasks == "lines":
        return _reader(spark, multi_line=False).csv(path)
    if tasks == "blocks":
        return read_csv_split(spark, path, _reader(spark, multi_line=True).csv(path).columns)
    raise ValueError(f"tasks must be 'files', 'blocks' or 'lines', not {tasks!r}")


def read_csv_typed(
    spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = True
) -> DataFrame:
    """CSV read straight into ``schema``, whose column order must be the header's.

    Without ``multi_line`` large files are divided; quoted newlines then end a record.
    """
    return _reader(spark, multi_line).schema(schema).csv(path)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Convert the named text columns; what does not parse becomes NULL."""

    def converted(name: str):
        kind = types.get(name)
        if kind is None:
            return F.col(name)
        if kind == "boolean":
            return text_to_boolean(F.col(name)).alias(name)
        return F.col(name).try_cast(kind).alias(name)

    return df.select(*map(converted, df.columns))


def ingest_csv(
    spark: SparkSession,
    source: str,
    target: str,
    types: Mapping[str, str],
    epoch: str | None = None,
    year: str = "review_year",
    month: str = "review_month",
    partition_by: Sequence[str] = (),
    tasks: Tasks = "files",
) -> None:
    """Raw CSV to typed Parquet, with year and month taken from the ``epoch`` column."""
    table = cast_columns(read_csv_raw(spark, source, tasks), types)
    if epoch is not None:
        table = add_period(table, epoch, year, month)
    write_table(table, target, partition_by)


def write_csv_raw(
    df: DataFrame, path: str, records_per_file: int = 200_000, compression: str = "none"
) -> None:
    """Write ``df`` as raw CSV.

    A file is one task when read back, so wide rows call for fewer
    ``records_per_file``. CSV does not tell an empty text from a missing one.
    ``compression="gzip"`` writes a fraction of the bytes, at gzip's fastest level;
    such files cannot be divided, which only matters for ``tasks`` "blocks" and "lines".
    """
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", records_per_file)
        .option("compression", compression)
        .option("zlib.compress.level", "BEST_SPEED")
        .csv(path)
    )
