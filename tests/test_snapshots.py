"""Differences of snapshots and stored distinct counts against plain Python."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from factlab.operators import distinct_bitmaps, key_changes, merged_distinct, row_changes

SCHEMA = "key string, added int, value double"


def _rows(seed, n):
    pick = random.Random(seed)
    return [
        (pick.choice(["hot"] * 3 + ["a", "b", "c", "d", None]), pick.choice([None, 1, 2]), pick.choice([None, 0.5]))
        for _ in range(n)
    ]


def _table(spark, found):
    return spark.createDataFrame(found, SCHEMA).repartition(3)


@pytest.mark.parametrize("sizes", [(200, 190), (12, 9), (0, 20), (20, 0), (0, 0)])
def test_changes_of_bags_of_rows(spark, sizes):
    old, new = (_rows(i, n) for i, n in enumerate(sizes))
    a, b = Counter(old), Counter(new)
    got = row_changes(_table(spark, old), _table(spark, new))
    assert got.columns == ["key", "added", "value", "added", "removed"]
    found = got.toDF("key", "x", "value", "added", "removed").collect()
    assert {tuple(row)[:3]: tuple(row)[3:] for row in found} == {
        row: (max(b[row] - a[row], 0), max(a[row] - b[row], 0)) for row in a | b if a[row] != b[row]
    }
    assert row_changes(_table(spark, old), _table(spark, old[::-1])).collect() == []

    want = {}
    for key in {row[0] for row in old + new}:
        one, two = ({r: n for r, n in side.items() if r[0] == key} for side in (a, b))
        if one != two:
            want[key] = "added" if not one else "removed" if not two else "changed"
    changes = key_changes(_table(spark, old), _table(spark, new), ["key"]).collect()
    assert dict(map(tuple, changes)) == want and len(changes) == len(want)


def test_changes_take_no_join_and_combine_copies_first(spark):
    table = _table(spark, _rows(1, 20))
    plan = key_changes(table, table, ["key"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("partial_") >= 2 and "Window" not in plan
    with pytest.raises(ValueError):
        row_changes(table, table.drop("value"))


def test_stored_bitmaps_merge_exactly(spark, tmp_path):
    pick = random.Random(4)
    ids = [None, 0, -1, -40_000, 32_767, 32_768, 32_769, 2**40, *range(1, 3000, 7)]
    found = [(pick.choice(["hot"] * 4 + ["a", "b", None]), pick.randrange(30), pick.choice(ids)) for _ in range(3000)]
    table = spark.createDataFrame(found, "key string, day int, id long")
    for part in (F.col("day") < 10, F.col("day") >= 10):  # stored by two runs
        bitmaps = distinct_bitmaps(table.where(part).repartition(3), ["key", "day"], "id")
        bitmaps.write.mode("append").parquet(str(tmp_path / "bits"))
    stored = spark.read.parquet(str(tmp_path / "bits"))
    weeks = merged_distinct(stored.withColumn("week", F.floor(F.col("day") / 7)), ["key", "week"], "ids")
    want = Counter(x[:2] for x in {(key, day // 7, id) for key, day, id in found if id is not None})
    assert {(r.key, r.week): r.ids for r in weeks.collect()} == want
    assert merged_distinct(stored, []).collect() == [(len({x[2] for x in found} - {None}),)]
    assert merged_distinct(stored.limit(0), []).collect() == [(0,)]
    assert merged_distinct(stored.limit(0), ["key"]).collect() == []
