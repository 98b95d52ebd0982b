"""Conjunctive filter with projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from factlab.functions import all_of


def filter_all(
    df: DataFrame, tests: Sequence[Column], columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows passing every test, reduced to ``columns`` if given.

    Comparisons and NULL tests reach the Parquet reader; a test on a function
    of a column, such as its length, runs after it.
    """
    kept = df.filter(all_of(tests))
    return kept if columns is None else kept.select(*columns)
