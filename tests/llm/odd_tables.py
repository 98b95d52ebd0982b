"""Small tables with NULLs, empty and blank texts, repeated rows and clashing names."""

from __future__ import annotations

from factlab.llm.common import importable

ODD_ROWS = [
    (1, "Some plain words stand here, one after the other, and end.", "a"),
    (2, None, "a"),
    (3, "", None),
    (4, " \t\n ", "b"),
    (None, "A row without an id has words as well, ten or more of them.", "b"),
    (5, "same row", "a"),
    (5, "same row", "a"),
    (6, "x" * 5000, "c"),
    (7, "ÀÉ ß 日本 語 <|endoftext|> it's 's  two  spaces\n\nand\tmore ", "c"),
    (8, "word " * 3000, None),
]
SCHEMA = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int"


def odd(spark):
    """The odd rows, with further columns named like those the operators make."""
    importable(spark)
    rows = [(*row, 1, None, "n") for row in ODD_ROWS]
    more = "size long, kept boolean, id string"
    return spark.createDataFrame(rows, f"{SCHEMA}, {more}").repartition(3)


def empty(spark):
    importable(spark)
    return spark.createDataFrame([], SCHEMA)


def table(spark, rows, schema=SCHEMA):
    importable(spark)
    return spark.createDataFrame(rows, schema)


def sf(spark, name):
    importable(spark)
    return spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
