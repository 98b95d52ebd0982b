"""Windows and sessions by event time, with a watermark, as Structured Streaming state.

The watermark is the greatest time seen in the batches before, less ``lateness``. State is
held for windows and sessions that end after it only, so it does not grow with the stream.
A row is late, and dropped, if its window or session has ended by the watermark; rows of
NULL time are in none. A group is given once, when the watermark reaches its end; groups
still open stay in the checkpoint for the next run.

Watermarks are of instants: times without a zone are read as UTC, in any session time
zone, and the results' times are again without one. Aggregates of the time itself get
the instant.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType


def stream_windows(
    stream: DataFrame,
    time: str,
    width: str,
    lateness: str,
    keys: Sequence[str],
    stats: Sequence[Column],
    once: Sequence[str] = (),
) -> DataFrame:
    """Columns window_start, window_end, ``keys`` and ``stats`` (named aggregates).

    Windows are ``width`` long ("1 hour") and start at its multiples. Rows are combined in
    the map tasks first, so a hot key is one partial row for each task and window.

    Columns ``once`` tell rows apart: of rows equal in them that come within ``lateness``
    one counts. That needs a state of one row for each such value within ``lateness``, and
    all rows in one shuffle, spread by these columns.
    """
    rows = _instants(stream, time).withWatermark(time, lateness)
    if once:
        rows = rows.dropDuplicatesWithinWatermark(list(once))
    grouped = rows.groupBy(F.window(time, width).alias("_window"), *keys).agg(*stats)
    return grouped.select(
        _as_given(stream, time, "_window.start").alias("window_start"),
        _as_given(stream, time, "_window.end").alias("window_end"),
        *[c for c in grouped.columns if c != "_window"],
    )


def stream_sessions(
    stream: DataFrame, time: str, gap: str, lateness: str, keys: Sequence[str], stats: Sequence[Column]
) -> DataFrame:
    """Columns ``keys``, session_start (first time), session_end (last time and ``gap``), ``stats``.

    Rows of a key that lie up to ``gap`` apart are in one session, as in
    ``operators.sessions``; rows of a NULL key are a key of their own.
    """
    rows = _instants(stream, time).withWatermark(time, lateness)
    grouped = rows.groupBy(F.session_window(time, gap).alias("_session"), *keys).agg(*stats)
    return grouped.select(
        *keys,
        _as_given(stream, time, "_session.start").alias("session_start"),
        _as_given(stream, time, "_session.end").alias("session_end"),
        *[c for c in grouped.columns if c != "_session" and c not in keys],
    )


def _zoneless(stream: DataFrame, time: str) -> bool:
    return stream.schema[time].dataType == TimestampNTZType()


def _instants(stream: DataFrame, time: str) -> DataFrame:
    """The rows that have a time, as an instant."""
    rows = stream.where(F.col(time).isNotNull())
    if not _zoneless(stream, time):
        return rows
    since = (F.col(time) - _epoch()).cast("interval second").cast("decimal(20, 6)")
    return rows.withColumn(time, F.timestamp_micros((since * 1_000_000).cast("long")))


def _as_given(stream: DataFrame, time: str, name: str) -> Column:
    if not _zoneless(stream, time):
        return F.col(name)
    seconds = (F.unix_micros(name) / F.lit(1_000_000).cast("decimal(7, 0)")).cast("decimal(18, 6)")
    return _epoch() + F.make_dt_interval(secs=seconds)


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
