"""Every registered query against its oracle in DuckDB."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as spark_entry

SF_DIR = os.environ.get("FACTLAB_SF_DIR", "/root/testdata/sf0.001")
QUERIES = spark_entry.queries()
ORACLES = spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def _sorted(rows):
    return sorted(rows, key=lambda row: [(value is not None, value or 0) for value in row])


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_oracle(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    oracle = duck.execute(ORACLES[name])
    names = [column[0] for column in oracle.description]
    expected = oracle.fetchall()
    assert sorted(result.columns) == sorted(names)
    actual = [tuple(row) for row in result.select(*names).collect()]
    assert _sorted(actual) == _sorted(expected)
    assert actual
    spark.catalog.clearCache()


#: Results in an order of their own, and the columns that give it.
ORDERED = {
    "q03_multi_key": ["-n"],
    "q04_top_k": ["-engagement", "l_partkey"],
    "q09_period": ["order_year", "order_month"],
    "q24_preview": ["-n", "l_suppkey", "l_returnflag"],
    "reviews_q03": ["-review_count"],
    "reviews_q09": ["review_year", "review_month"],
    "reviews_sql_q3": ["-review_count"],
    "reviews_sql_q6": ["appid", "review_date"],
    "reviews_sql_q9": ["review_year", "review_month"],
}


@pytest.mark.parametrize("name", ORDERED)
def test_results_come_in_order(spark, name):
    rows = QUERIES[name](spark, SF_DIR).collect()
    keys = [tuple(_turned(row[c.lstrip("-")], c[0] == "-") for c in ORDERED[name]) for row in rows]
    assert keys == sorted(keys) and len(rows) > 1


def _turned(value, down):
    return -value if down else value


def test_every_query_has_an_oracle():
    """Those of the training-data operators that SQL cannot express have tests of their own."""
    plain = {name for name in QUERIES if not name.startswith(("op", "pipeline"))}
    assert plain <= ORACLES.keys() <= QUERIES.keys()


def test_entry(spark):
    result = spark_entry.entry(spark)
    assert result.columns == ["l_partkey", "n", "avg_discount", "avg_quantity", "sum_lines"]
    assert result.count() == 38
