"""Streams of files against batch results: late rows, restarts, NULLs, hot keys, plans."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from factlab.operators import sessions
from factlab.streaming import file_stream, run_available, stream_sessions, stream_windows

SCHEMA = "id long, key string, at timestamp_ntz"
START = datetime(2024, 3, 30, 22)  # the night of a change of clocks in Europe


def _count():
    return [F.count("*").alias("n")]


def _minute(n):
    return None if n is None else START + timedelta(minutes=n)


def _table(spark, found):
    return spark.createDataFrame([(i, key, _minute(at)) for i, key, at in found], SCHEMA)


def _add(spark, folder, found):
    """One more file."""
    _table(spark, found).coalesce(1).write.mode("append").parquet(str(folder))


def _hourly(spark, folder, files=None, once=()):
    stream = file_stream(spark, str(folder), SCHEMA, files)
    return stream_windows(stream, "at", "1 hour", "30 minutes", ["key"], _count(), once)


def _windows(spark, path):
    found = spark.read.parquet(str(path)).collect()
    return Counter({(row.window_start, row.key): row.n for row in found}), len(found)


def test_windows_equal_the_batch(spark, tmp_path):
    pick = random.Random(1)
    found = [(i, pick.choice(["hot", "hot", "a", None]), pick.choice([None, *range(600)])) for i in range(400)]
    _add(spark, tmp_path / "in", found)
    progress = run_available(_hourly(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"))
    assert progress.rows == 400 and progress.late == 0
    mark = max(at for *_, at in found if at is not None) - 30
    want = Counter((_minute(at // 60 * 60), key) for _, key, at in found if at is not None and at // 60 * 60 + 60 <= mark)
    assert _windows(spark, tmp_path / "out") == (want, len(want))


def test_late_rows_are_counted_and_repeats_count_once(spark, tmp_path):
    def run():
        result = _hourly(spark, tmp_path / "in", once=["id"])
        return run_available(result, str(tmp_path / "out"), str(tmp_path / "check"))

    _add(spark, tmp_path / "in", [(1, "a", 10), (2, "a", 20), (2, "a", 20), (3, "a", 200)])
    assert run().late == 0  # the watermark is now 170
    _add(spark, tmp_path / "in", [(4, "a", 30), (5, "b", 31), (6, "a", 175), (3, "a", 200), (7, "a", 400)])
    assert run().late == 2  # rows 4 and 5
    got, n = _windows(spark, tmp_path / "out")
    assert got == {(_minute(0), "a"): 2, (_minute(120), "a"): 1, (_minute(180), "a"): 1} and n == 3


def test_a_restart_gives_no_window_twice(spark, tmp_path):
    """Runs that read one file a batch, die in between, or find nothing new."""
    folder, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    for hour in range(3):
        _add(spark, folder, [(i, "a", 60 * hour + i) for i in range(0, 60, 7)])
    run_available(_hourly(spark, folder, files=1), out, check)
    before = _windows(spark, out)
    assert run_available(_hourly(spark, folder, files=1), out, check).rows == 0
    assert _windows(spark, out) == before

    broken = _hourly(spark, folder).withColumn("n", F.expr("if(n > 0, raise_error('lost'), n)"))
    _add(spark, folder, [(1, "a", 1000)])
    with pytest.raises(Exception, match="lost"):
        run_available(broken, out, check)
    assert _windows(spark, out) == before
    run_available(_hourly(spark, folder), out, check)
    assert _windows(spark, out) == ({(_minute(60 * hour), "a"): 9 for hour in range(3)}, 3)


def test_empty_stream(spark, tmp_path):
    _add(spark, tmp_path / "in", [])
    assert run_available(_hourly(spark, tmp_path / "in"), str(tmp_path / "o"), str(tmp_path / "c")).rows == 0


def _slow_sessions(found, gap):
    last, out = {}, {}
    for _, key, at in sorted((x for x in found if x[2] is not None), key=lambda x: x[2]):
        if key not in last or at - last[key][1] > gap:
            number = last[key][0] + 1 if key in last else 1
            out[key, number] = [at, at, 0]
        else:
            number = last[key][0]
        last[key] = (number, at)
        out[key, number][1] = at
        out[key, number][2] += 1
    return {(key, n, _minute(a), _minute(b), count) for (key, n), (a, b, count) in out.items()}


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("gap", [1, 7, 30])
def test_sessions_are_gaps_and_islands(spark, gap, kind, zone):
    if (kind, zone) == ("timestamp", "Europe/Berlin"):
        pytest.skip("Python's own times have no zone to compare with")
    pick = random.Random(gap)
    found = [
        (i, pick.choice(["hot"] * 4 + ["a", "b", None]), pick.choice([None, *range(-2000, 2000)])) for i in range(600)
    ]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        table = _table(spark, found + found[:5]).withColumn("at", F.col("at").cast(kind)).repartition(5)
        got = sessions(table, ["key"], "at", gap * 60).withColumns(
            {c: F.col(c).cast("timestamp_ntz") for c in ("first_at", "last_at")}
        )
        assert set(map(tuple, got.collect())) == _slow_sessions(found + found[:5], gap)
        assert sessions(table.limit(0), ["key"], "at", 60).collect() == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_sessions_sort_one_row_for_each_stretch(spark):
    """100,000 rows of one key in two hours reach the window as five rows for each input task."""
    table = spark.range(0, 100_000, 1, 4).select(
        F.lit("hot").alias("key"), F.timestamp_seconds(F.col("id") % 7200 + 900).alias("at")
    )
    found = sessions(table, ["key"], "at", 1800)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count") == 1 and plan.index("Window") < plan.index("partial_count")
    assert rows(found.select("session", "n")) == [(1, 100_000)]


def test_stream_sessions_equal_the_batch(spark, tmp_path):
    pick = random.Random(3)
    found = [(i, pick.choice(["hot", "hot", "a", "b", None]), pick.choice([None, *range(900)])) for i in range(200)]
    _add(spark, tmp_path / "in", found)
    stream = file_stream(spark, str(tmp_path / "in"), SCHEMA)
    result = stream_sessions(stream, "at", "10 minutes", "1 hour", ["key"], _count())
    run_available(result, str(tmp_path / "out"), str(tmp_path / "check"))
    mark = _minute(max(at for *_, at in found if at is not None) - 60)
    ten = timedelta(minutes=10)
    want = {(key, a, b + ten, n) for key, _, a, b, n in _slow_sessions(found, 10) if b + ten <= mark}
    assert set(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == want and want
