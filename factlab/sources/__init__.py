"""Reading and writing tables: Parquet, raw CSV, inline rows, named views."""

from factlab.sources.raw_csv import (
    cast_columns,
    ingest_csv,
    read_csv_raw,
    read_csv_typed,
    write_csv_raw,
)
from factlab.sources.scratch import fresh_path
from factlab.sources.tables import dim_table, read_table, register, write_table

__all__ = [
    "cast_columns",
    "dim_table",
    "fresh_path",
    "ingest_csv",
    "read_csv_raw",
    "read_csv_typed",
    "read_table",
    "register",
    "write_csv_raw",
    "write_table",
]
