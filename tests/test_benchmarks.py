from __future__ import annotations

import pytest

from factlab import benchmarks
from factlab.session import SQL_OPTIONS, shuffle_options

WORKLOADS = {"all": lambda t: t, "few": lambda t: t.filter("id < 3")}


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(10)


def test_run_once_counts_rows_and_takes_time(table):
    seconds = []
    assert benchmarks.run_once(table, seconds) == 10
    assert len(seconds) == 1 and seconds[0] > 0


def test_compare_formats(table):
    result = benchmarks.compare_formats(table, table, WORKLOADS, repeats=2)
    found = {row["workload"]: row for row in result.collect()}
    assert found["all"]["csv_rows"] == found["all"]["parquet_rows"] == 10
    assert found["few"]["csv_rows"] == 3
    assert found["few"]["ratio"] == pytest.approx(
        found["few"]["csv_sec"] / found["few"]["parquet_sec"]
    )
    mean = benchmarks.mean_ratio(result).collect()[0]["mean_ratio"]
    assert mean == pytest.approx((found["all"]["ratio"] + found["few"]["ratio"]) / 2, abs=0.051)


def test_sweep_sets_and_restores_the_width(spark, table):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = set()

    def grouped(t):
        seen.add(
            (spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled"))
        )
        return t.groupBy("id").count()

    result = benchmarks.sweep_partitions(table, {"g": grouped}, (2, 3), 1, warm_up=False)
    assert seen == {("2", "false"), ("3", "false")}
    found = result.collect()
    assert [(row["partitions"], row["rows"]) for row in found] == [(2, 10), (3, 10)]
    assert sum(row["best"] for row in found) == 1
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_settings_are_restored_after_an_error(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(RuntimeError):
        with benchmarks.sql_settings(spark, {"spark.sql.shuffle.partitions": "77"}):
            raise RuntimeError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_profiles(table):
    def halves(df):
        return df.groupBy(df[df.columns[0]]).count().limit(5)

    workloads = {"count": benchmarks.count_rows, "groups": halves}
    found = benchmarks.time_profiles(table, workloads=workloads, repeats=1).collect()
    assert [(row["profile"], row["workload"], row["rows"]) for row in found] == [
        (profile, workload, rows)
        for workload, rows in (("count", 10), ("groups", found[-1]["rows"]))
        for profile in ("default", "low", "high")
    ]


def test_session_options(spark):
    for key, value in SQL_OPTIONS.items():
        assert spark.conf.get(key) == value


def test_shuffle_width_follows_the_input():
    assert shuffle_options(1 << 20, 8)["spark.sql.shuffle.partitions"] == "8"
    assert shuffle_options(5 << 30, 8)["spark.sql.shuffle.partitions"] == "40"
    assert shuffle_options(100 << 40, 8)["spark.sql.shuffle.partitions"] == "819200"
