from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from factlab.operators import (
    Stat,
    above_global_mean,
    daily_counts,
    global_mean,
    grouped_stats,
    period_summary,
)
from factlab.plans.inspect import plan_text

STATS = [
    Stat("mean", "mean", "score", 4),
    Stat("total", "sum", "votes"),
    Stat("spread", "std", "score", 4),
]


@pytest.fixture(scope="module")
def scores(spark):
    return spark.createDataFrame(
        [
            (1, 1.0, 4),
            (1, None, None),
            (1, 0.5, 2),
            (2, None, None),
            (2, None, None),
            (3, 0.25, 7),
            (None, 0.5, 1),
        ],
        "key int, score double, votes int",
    )


def test_null_values_are_skipped(scores):
    assert rows(grouped_stats(scores, ["key"], STATS, ddof=0)) == [
        (None, 1, 0.5, 1, 0.0),
        (1, 3, 0.75, 6, 0.25),
        (2, 2, None, None, None),
        (3, 1, 0.25, 7, 0.0),
    ]


def test_null_values_as_zero(scores):
    assert rows(grouped_stats(scores, ["key"], STATS, nulls="zero", ddof=0)) == [
        (None, 1, 0.5, 1, 0.0),
        (1, 3, 0.5, 6, 0.4082),
        (2, 2, 0.0, 0, 0.0),
        (3, 1, 0.25, 7, 0.0),
    ]


def test_sample_deviation_of_one_row_is_null(scores):
    found = {row["key"]: row["spread"] for row in grouped_stats(scores, ["key"], STATS).collect()}
    assert found == {None: None, 1: 0.3536, 2: None, 3: None}


@pytest.mark.parametrize("options", [{"nulls": "drop"}, {"ddof": 2}])
def test_unknown_options_are_refused(scores, options):
    with pytest.raises(ValueError):
        grouped_stats(scores, ["key"], STATS, **options)


def test_minimum_rows_is_inclusive(spark):
    df = spark.range(99).select((F.col("id") >= 50).alias("late"))
    assert rows(grouped_stats(df, ["late"], [], min_rows=50)) == [(False, 50)]


def test_no_keys_give_one_row(scores):
    assert rows(grouped_stats(scores, [], STATS[:1])) == [(7, 0.5625)]
    assert rows(global_mean(scores, "score")) == [(0.5625,)]


def test_aggregation_starts_in_the_map_tasks(hot_table):
    text = plan_text(grouped_stats(hot_table, ["key"], [Stat("m", "mean", "score")]), "simple")
    assert "partial_avg" in text and "partial_count" in text
    assert "row_id" not in text.split("ReadSchema")[1].splitlines()[0]


def test_daily_counts_leave_out_rows_without_a_day(spark):
    df = spark.createDataFrame([(1, 0), (1, 86_399), (1, 86_400), (2, None)], "k int, t bigint")
    counts = daily_counts(df, "k", "t", "day", "n").select("k", F.unix_date("day"), "n")
    assert rows(counts) == [(1, 0, 2), (1, 1, 1)]


def test_period_summary_is_in_order(spark):
    df = spark.createDataFrame(
        [(2019, 3, 1.0), (2019, 1, 2.0), (2018, 1, 5.0), (None, None, 1.0), (2019, 1, None)],
        "y int, m int, v double",
    )
    stats = [Stat("mean", "mean", "v", 4)]
    found = [tuple(row) for row in period_summary(df, ["y", "m"], stats, [2019]).collect()]
    assert found == [(2019, 1, 2, 2.0), (2019, 3, 1, 1.0)]
    zero = period_summary(df, ["y", "m"], stats, [2019], nulls="zero").collect()
    assert [tuple(row) for row in zero] == [(2019, 1, 2, 1.0), (2019, 3, 1, 1.0)]


def test_above_global_mean(spark):
    values = [(1, 1.0)] * 19 + [(2, 1.0)] * 20 + [(3, 0.0)] * 39 + [(4, 0.5)] * 30
    values += [(5, None)] * 30 + [(None, 0.5)] * 10
    df = spark.createDataFrame(values, "key int, value double")
    # Overall mean 0.5: key 1 is too small, key 4 equal and not above, key 5 has no values.
    found = above_global_mean(df, "key", "value", "mean", min_rows=20)
    assert rows(found) == [(2, 1.0, 20)]


def test_overall_mean_includes_rows_without_key(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0), (None, 10.0)], "key int, value double")
    assert rows(above_global_mean(df, "key", "value", "mean")) == [(None, 10.0, 1)]


def test_group_means_and_overall_mean_share_a_scan(hot_table):
    result = above_global_mean(hot_table, "key", "score", "mean")
    result.collect()
    final = plan_text(result, "simple")
    assert "ReusedExchange" in final
