"""Time joins, numbering and grouping sets against plain Python: NULLs, ties, hot keys, plans."""

from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from factlab.benchmarks import sql_settings
from factlab.operators import Stat, asof_join, grouped_levels, interval_join, numbered, ranked


def _events(seed, n):
    pick = random.Random(seed)
    keys = [7] * 4 + [1, 2, 3, None]  # key 7 is hot
    return [(i, pick.choice(keys), pick.choice([None, *range(40)]), pick.choice([None, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_asof_join_is_the_last_earlier_row(spark, width):
    left, right = _events(1, 150), _events(2, 60)
    schema = "{0}id int, {0}key int, {0}time int, {0}value int"
    one = spark.createDataFrame(left, schema.format("")).repartition(3)
    two = spark.createDataFrame(right, schema.format("r_")).repartition(3)
    columns = {"r_time": "time_of", "r_value": "value_of", "r_id": "id_of"}
    bucket = lambda name: F.floor(F.col(name) / width)
    got = asof_join(one, two, [("key", "r_key")], "time", "r_time", columns, bucket)
    want = []
    for row in left:
        fit = [
            (t, -1 if v is None else v, i)
            for i, k, t, v in right
            if None not in (k, t, row[1], row[2]) and k == row[1] and t <= row[2]
        ]
        t, v, i = max(fit, default=(None, -1, None))
        want.append((*row, t, None if v == -1 else v, i))
    assert rows(got) == rows(spark.createDataFrame(want, got.schema))


def test_asof_join_meets_by_key_and_bucket(spark):
    table = spark.createDataFrame(_events(1, 20), "id int, key int, time int, value int")
    other = table.toDF("a", "b", "c", "d")
    joined = asof_join(table, other, [("key", "b")], "time", "c", {"d": "e"}, lambda x: F.col(x))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "_k0#" in plan and "_bucket#" in plan


@pytest.mark.parametrize("width", [1, 5, 100])
def test_interval_join_gives_each_pair_once(spark, width):
    pick = random.Random(width)
    spans = []
    for i in range(120):
        a = pick.choice([None, *range(50)])
        b = None if a is None else a + pick.randint(-2, 12)
        spans.append((i, pick.choice([7, 7, 7, 1, 2, None]), a, b))
    spans += spans[:5]
    one = spark.createDataFrame(spans, "i int, k int, a int, b int").repartition(3)
    two = one.toDF("j", "l", "c", "d")
    bucket = lambda name: F.floor(F.col(name) / width)
    got = interval_join(one, two, [("k", "l")], ("a", "b"), ("c", "d"), bucket)
    want = [
        (*x, *y)
        for x in spans
        for y in spans
        if None not in (*x, *y) and x[1] == y[1] and max(x[2], y[2]) <= min(x[3], y[3]) and x[2] <= x[3] and y[2] <= y[3]
    ]
    assert rows(got) == sorted(want)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_ranks_of_ties_and_nulls(spark):
    pick = random.Random(3)
    values = [pick.choice([None, 5, 5, 5, 5, 1, 9, 2]) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, row_number int").repartition(4)
    for order, turned in (("row_number", False), ("-row_number", True)):
        got = ranked(df, [order], "n", "r", "d", "p", "c", ("t", 7)).collect()
        ordered = sorted(values, key=lambda x: (x is not None, x or 0), reverse=turned)
        distinct = list(dict.fromkeys(ordered))
        assert sorted(x.n for x in got) == list(range(1, 501))
        assert [x.row_number for x in sorted(got, key=lambda x: x.n)] == ordered
        sizes = [sum(x.t == t for x in got) for t in range(1, 8)]
        assert sizes == [72] * 3 + [71] * 4
        for x in got:
            first, ties = ordered.index(x.row_number) + 1, ordered.count(x.row_number)
            assert (x.r, x.d) == (first, distinct.index(x.row_number) + 1)
            assert x.p == pytest.approx((first - 1) / 499) and x.c == pytest.approx((first + ties - 1) / 500)
    assert numbered(df.limit(0), ["id"]).collect() == []
    assert ranked(df.limit(0), ["id"], "n", "r", "d", "p", "c", ("t", 7)).collect() == []


def test_a_hot_value_is_numbered_by_many_tasks(spark):
    with_hot = spark.range(0, 40_000, 1, 8).select(F.lit(1).alias("same"), "id")
    with sql_settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        got = numbered(with_hot, ["same"])
        assert got.agg(F.count_distinct("row_number"), F.max("row_number")).first() == (40_000, 40_000)
    path = got.inputFiles()[0].rsplit("/", 1)[0]
    tasks = spark.read.parquet(path).groupBy(F.shiftright("_at", 33).alias("t")).count().collect()
    assert len(tasks) == 4 and max(x["count"] for x in tasks) < 20_000


def test_totals_differ_from_null_keys(spark):
    df = spark.createDataFrame([(None, "x", 1), (None, "y", 2), ("a", "x", None)], "k string, j string, v int")
    stats = [Stat("s", "sum", "v")]
    got = set(map(tuple, grouped_levels(df, ["k", "j"], [["k"], []], stats).collect()))
    assert got == {(None, None, 1, 2, 3), ("a", None, 1, 1, None), (None, None, 3, 3, 3)}
    assert grouped_levels(df, ["k", "j"], "cube", stats).count() == 3 + 2 + 2 + 1
    assert grouped_levels(df, ["k", "j"], "rollup", stats).count() == 3 + 2 + 1


def test_single_winner_reads_its_input_three_times_at_most(spark, hot_table):
    from factlab.operators import top_ranked

    plan = top_ranked(hot_table, ["key"], ["score"], ties="one", tie_break=["row_id", "score", "row_id"])
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan") <= 3
