"""Rows with and without partners, outer joins, JSON columns and sketches against plain Python."""

from __future__ import annotations

import json
import random
import statistics

import pytest
from pyspark.sql import functions as F

from conftest import rows
from factlab.functions import json_columns
from factlab.operators import (
    distinct_sketches,
    error_bound,
    exists_in,
    merged_distinct_estimate,
    merged_quantiles,
    not_exists_in,
    not_in,
    outer_join,
    quantile_sketches,
)

ON = [("a", "x"), ("b", "y")]


def _side(spark, seed, n, names):
    pick = random.Random(seed)
    found = [
        (pick.choice([7] * 6 + [None, None, *range(12)]), pick.choice([0.0, -0.0, 1.5, None, float("nan")]), i % 5)
        for i in range(n)
    ]
    return found, spark.createDataFrame(found, names).repartition(3)


def _plain(row):
    """Keys as the join compares them: NaN equals itself, NULL equals nothing."""
    return None if None in row[:2] else (row[0], "nan" if row[1] != row[1] else row[1] + 0.0)


def _shown(found):
    return sorted(str([str(v) if v != 0 else "0.0" for v in row]) for row in found)


@pytest.mark.parametrize("sizes", [(120, 40), (0, 30), (30, 0), (0, 0)])
def test_matches_and_outer_joins(spark, sizes):
    left, one = _side(spark, 1, sizes[0], "a int, b double, i long")
    right, two = _side(spark, 2, sizes[1], "x long, y double, j long")
    keys = {_plain(row) for row in right} - {None}
    lefts = {_plain(row) for row in left} - {None}
    assert _shown(exists_in(one, two, ON).collect()) == _shown(r for r in left if _plain(r) in keys)
    lone = [r for r in left if _plain(r) not in keys]
    assert _shown(not_exists_in(one, two, ON).collect()) == _shown(lone)
    pairs = [l + r for l in left for r in right if _plain(l) is not None and _plain(l) == _plain(r)]
    pairs += [r + (None,) * 3 for r in lone]
    assert _shown(outer_join(one, two, ON).collect()) == _shown(pairs)
    pairs += [(None,) * 3 + r for r in right if _plain(r) not in lefts]
    assert _shown(outer_join(one, two, ON, "full").collect()) == _shown(pairs)


@pytest.mark.parametrize("others", [[], [1, 1, 3], [1, None], [None]])
def test_not_in_is_that_of_sql(spark, others):
    left = spark.createDataFrame([(v,) for v in [1, 1, 2, 2, None, 4]], "v int")
    right = spark.createDataFrame([(v,) for v in others], "o long")
    left.createOrReplaceTempView("not_in_left")
    right.createOrReplaceTempView("not_in_right")
    want = spark.sql("select v from not_in_left where v not in (select o from not_in_right)")
    assert rows(not_in(left, right, "v", "o")) == rows(want)


def test_misuse_is_refused(spark):
    one = spark.createDataFrame([], "a int, b string")
    with pytest.raises(ValueError):
        exists_in(one, one, [("a", "b")])
    with pytest.raises(ValueError):
        outer_join(one, one, [("a", "a")])
    with pytest.raises(ValueError):
        outer_join(one, one.toDF("c", "d"), [("a", "c")], "right")


def test_null_and_hot_keys_are_many_tasks(skewed_session, hot_table):
    spark = skewed_session
    left = hot_table.withColumn("key", F.expr("if(row_id % 4 = 0, null, key)"))
    right = hot_table.where("row_id < 500").select(F.col("key").alias("k"), F.col("row_id").alias("r"))
    joins = [
        outer_join(left, right.where("k <> 7 or r < 2"), [("key", "k")], "full"),
        not_exists_in(left, right, [("key", "k")]),
        not_in(left, right, "key", "k"),
    ]
    lone = F.count_if(F.col("key").isNull()).alias("lone")
    for df, has_nulls in zip(joins, (True, True, False)):
        # The sum keeps row_id in the shuffle, where it gives the rows their size.
        placed = df.groupBy(F.spark_partition_id().alias("part")).agg(lone, F.sum("row_id"))
        found = [row.lone for row in placed.collect()]
        plan = placed._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
        # Read in four partitions, two of which may share a task; in one task without the digest.
        assert max(found) <= sum(found) / 2 and (sum(found) > 0) == has_nulls


TEXTS = [
    '{"k": 5, "m": {"a": "q", "l": [1, 2]}}', '{"k": "zz"}', '{"k": null}', "{}", "[1]", '"k"', "{bad", "", None,
    '{"k": "12"}', '{"k": 99999999999999999999}', '{"k": 3, "m": 4}', '{"m": {"a": 1, "l": ["x", {}]}}',
]


def test_json_columns(spark):
    table = spark.createDataFrame([(t, "kept") for t in TEXTS], "props string, k2 string")
    fields = {"k": ("$.k", "int"), "a": ("$.m.a", "string"), "second": ("$.m.l[1]", "int")}
    found = json_columns(table, "props", fields).collect()
    for text, row in zip(TEXTS, found):
        try:
            value = None if text is None else json.loads(text)
            wrong = []
        except ValueError:
            value, wrong = None, ["not json"]
        value = value if isinstance(value, dict) else {}
        k = value.get("k")
        inner = value["m"] if isinstance(value.get("m"), dict) else {}
        second = inner["l"][1] if len(inner.get("l", [])) > 1 else None
        want = int(k) if k is not None and str(k).isdigit() and int(k) < 2**31 else None
        wrong += ["k"] * (k is not None and want is None)
        wrong += ["second"] * isinstance(second, dict)
        assert (row.k, row.k2, row.problems) == (want, "kept", wrong), text
        assert row.a == (None if inner.get("a") is None else str(inner["a"]))
        assert row.second == (second if isinstance(second, int) else None)
    pruned = json_columns(table, "props", fields).select("k")._jdf.queryExecution().optimizedPlan().toString()
    assert "$.m" not in pruned and pruned.count("try_variant_get") == 1
    assert json_columns(table.limit(0), "props", fields).collect() == []


def test_sketches_merge_within_their_bounds(spark, tmp_path):
    pick = random.Random(3)
    found = [
        (pick.choice(["hot"] * 3 + ["a", None]), pick.randrange(30), pick.choice([None, pick.randrange(20_000)]))
        for _ in range(60_000)
    ] + [("few", 1, 4), ("few", 2, 4), ("few", 3, 9), ("none", 1, None)]
    table = spark.createDataFrame(found, "key string, day int, value long").repartition(4)
    path = str(tmp_path / "distinct")
    distinct_sketches(table, ["key", "day"], "value").write.parquet(path)
    got = merged_distinct_estimate(spark.read.parquet(path), ["key"], "u").collect()
    for row in got:
        values = [v for k, _, v in found if k == row.key and v is not None]
        assert row.n == len(values)
        assert abs(row.u - len(set(values))) <= len(set(values)) * error_bound(deviations=5)
    assert {row.key: row.u for row in got}["few"] == 2 and {row.key: row.u for row in got}["none"] == 0

    path = str(tmp_path / "spread")
    quantile_sketches(table, ["key", "day"], "value").write.parquet(path)
    got = merged_quantiles(spark.read.parquet(path), ["key"], {"low": 0, "half": 0.5, "top": 1}).collect()
    assert {row.key for row in got} == {"hot", "a", None, "few"}
    for row in got:
        values = sorted(v for k, _, v in found if k == row.key and v is not None)
        assert (row.n, row.low, row.top) == (len(values), values[0], values[-1])
        if row.key == "few":
            assert row.half == statistics.median_low(values)
        under = sum(v <= row.half for v in values) / len(values)
        assert row.key == "few" or abs(under - 0.5) <= 0.02
    empty = merged_distinct_estimate(spark.read.parquet(str(tmp_path / "distinct")).limit(0), [], "u")
    assert [tuple(row) for row in empty.collect()] == [(0, 0)]
