from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import rows

from factlab.operators import moving_average
from factlab.plans.inspect import plan_text

START = dt.date(2020, 2, 20)


def _daily(spark, data):
    return spark.createDataFrame(
        [(key, START + dt.timedelta(days=day), n) for key, day, n in data],
        "key int, day date, n bigint",
    )


def test_range_and_rows_differ_on_missing_days(spark):
    daily = _daily(spark, [(1, 0, 10), (1, 6, 20), (1, 7, 30), (1, 30, 40), (2, 3, 5)])
    ranged = moving_average(daily, "key", "day", "n", "avg")
    assert [row["avg"] for row in ranged.orderBy("key", "day").collect()] == [10, 15, 25, 40, 5]
    by_rows = moving_average(daily, "key", "day", "n", "avg", frame="rows")
    assert [row["avg"] for row in by_rows.orderBy("key", "day").collect()] == [10, 15, 20, 25, 5]


@pytest.mark.parametrize("frame", ["range", "rows"])
def test_against_brute_force(spark, frame):
    rng = random.Random(3)
    data = sorted(
        (key, day, rng.randrange(50))
        for key in range(5)
        for day in rng.sample(range(60), 25)
    )
    expected = []
    for key, day, n in data:
        past = [item for item in data if item[0] == key and item[1] <= day]
        kept = [item for item in past if item[1] > day - 7] if frame == "range" else past[-7:]
        mean = sum(item[2] for item in kept) / len(kept)
        expected.append((key, START + dt.timedelta(days=day), n, pytest.approx(mean, abs=0.00501)))
    result = moving_average(_daily(spark, data), "key", "day", "n", "avg", frame=frame)
    assert rows(result) == expected


@pytest.mark.parametrize("frame", ["range", "rows"])
def test_ordered_result_costs_no_second_shuffle(spark, frame):
    rng = random.Random(4)
    data = [(key, day, 1) for key in range(50) for day in range(20)]
    rng.shuffle(data)
    daily = _daily(spark, data)
    plain = moving_average(daily, "key", "day", "n", "avg", frame=frame)
    ordered = moving_average(daily, "key", "day", "n", "avg", frame=frame, ordered=True)
    text = plan_text(ordered, "simple")
    assert text.count("Exchange") == 1 and text.count("Sort") == 1
    assert [tuple(row) for row in ordered.collect()] == rows(plain)


def test_unknown_frame_is_refused(spark):
    with pytest.raises(ValueError):
        moving_average(_daily(spark, [(1, 0, 1)]), "key", "day", "n", "avg", frame="weeks")
