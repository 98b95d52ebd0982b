"""Moving average over a daily series."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def moving_average(
    daily: DataFrame,
    key: str,
    day: str,
    value: str,
    name: str,
    days: int = 7,
    frame: Literal["range", "rows"] = "range",
    digits: int = 2,
    ordered: bool = False,
) -> DataFrame:
    """Add the mean of ``value`` over the last ``days`` days of each key.

    ``frame="range"`` looks back over calendar days, ``"rows"`` over the last
    ``days`` rows. Either way the divisor is the number of rows in the frame: a
    day without a row is not a zero. ``daily`` holds one row per key and day, as
    ``daily_counts`` makes it, so one key has at most one row per calendar day
    in its task, however many fact rows lie behind it.

    ``ordered`` returns the rows in order of key and day. The series is then
    range partitioned by key before the window, which serves window and order
    alike, where sorting the result would shuffle it again.
    """
    # As text, since only there a range over dates can be given in days; ordering
    # by the day number instead would hide the order from the sort below.
    if frame not in ("range", "rows"):
        raise ValueError(f"frame must be 'range' or 'rows', not {frame!r}")
    back = f"interval {days - 1} days" if frame == "range" else str(days - 1)
    average = F.expr(
        f"avg(`{value}`) over (partition by `{key}` order by `{day}`"
        f" {frame} between {back} preceding and current row)"
    )
    if ordered:
        daily = daily.repartitionByRange(key)
    averages = daily.withColumn(name, F.round(average, digits))
    return averages.orderBy(key, day) if ordered else averages
