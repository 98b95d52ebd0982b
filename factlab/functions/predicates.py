"""Row tests. NULL passes none of them."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def at_least(column: str, value) -> Column:
    """``column >= value``. A FLOAT column is compared as DOUBLE: a stored 0.7f fails 0.7."""
    return F.col(column) >= F.lit(value)


def is_true(column: str) -> Column:
    return F.col(column) == F.lit(True)


def long_text(column: str, characters: int) -> Column:
    return F.length(column) >= characters


def not_null(*columns: str) -> Column:
    return all_of(F.col(name).isNotNull() for name in columns)


def one_of(column: str, values: Iterable) -> Column:
    return F.col(column).isin(*values)


def all_of(tests: Iterable[Column]) -> Column:
    return reduce(and_, tests)
