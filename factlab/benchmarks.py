"""Benchmark jobs: file formats, shuffle widths and session profiles.

Each workload is a function from a table to a DataFrame, and is timed by writing
its result to Spark's noop sink, which computes every row and column. A
``count`` at the end would let Spark leave out all it does not need for counting.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from statistics import median

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from factlab.operators import Stat, grouped_stats, top_ranked
from factlab.plans import reviews

Workload = Callable[[DataFrame], DataFrame]


def count_rows(table: DataFrame) -> DataFrame:
    return table.select(F.lit(1).alias("one"))


def scan_columns(table: DataFrame) -> DataFrame:
    return table.select("appid", "weighted_vote_score", "playtime_forever")


def group_by_verdict(table: DataFrame) -> DataFrame:
    score = Stat("avg_helpfulness", "mean", "weighted_vote_score")
    return grouped_stats(table, ["appid", "voted_up"], [score], "review_count")


def rank_by_score(table: DataFrame) -> DataFrame:
    scored = table.filter(F.col("weighted_vote_score").isNotNull())
    return top_ranked(scored, ["appid"], ["weighted_vote_score"], "influence_rank")


FORMAT_WORKLOADS: dict[str, Workload] = {
    "count": count_rows,
    "aggregation": reviews.game_stats,
    "complex_filter": reviews.elite_reviews,
    "column_scan": scan_columns,
}
SWEEP_WORKLOADS: dict[str, Workload] = {
    "q2": reviews.game_stats,
    "q3": group_by_verdict,
    "q5": rank_by_score,
}

PROFILE_WORKLOADS: dict[str, Workload] = {
    "count": count_rows,
    "aggregation": reviews.game_stats,
}

# Shuffle widths of the sweep, and the SQL settings of the profiles.
SWEEP_PARTITIONS = (50, 100, 200, 400)
PROFILES = {
    "default": {"spark.sql.shuffle.partitions": "200"},
    "low": {"spark.sql.shuffle.partitions": "50"},
    "high": {"spark.sql.shuffle.partitions": "400"},
}


@contextmanager
def sql_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Change session settings for the length of a block."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def timer(seconds: list[float]) -> Iterator[None]:
    """Append the wall-clock seconds of a block to ``seconds``."""
    start = time.perf_counter()
    try:
        yield
    finally:
        seconds.append(time.perf_counter() - start)


def run_once(df: DataFrame, seconds: list[float]) -> int:
    """Compute all of ``df``, time it, and return its number of rows."""
    rows = Observation()
    observed = df.observe(rows, F.count(F.lit(1)).alias("rows"))
    with timer(seconds):
        observed.write.format("noop").mode("overwrite").save()
    return rows.get["rows"]


def compare_formats(
    csv: DataFrame,
    parquet: DataFrame,
    workloads: Mapping[str, Workload] = FORMAT_WORKLOADS,
    repeats: int = 3,
    warm_up: bool = True,
) -> DataFrame:
    """Each workload over both formats, alternating; median seconds and their ratio."""
    results = []
    for name, workload in workloads.items():
        tables = {"csv": workload(csv), "parquet": workload(parquet)}
        if warm_up:
            for table in tables.values():
                run_once(table, [])
        seconds: dict[str, list[float]] = {"csv": [], "parquet": []}
        rows = {}
        for turn in range(repeats):
            for kind in ("csv", "parquet") if turn % 2 == 0 else ("parquet", "csv"):
                rows[kind] = run_once(tables[kind], seconds[kind])
        took = {kind: median(values) for kind, values in seconds.items()}
        ratio = took["csv"] / took["parquet"]
        results.append(
            (name, rows["csv"], rows["parquet"], took["csv"], took["parquet"], ratio)
        )
    return csv.sparkSession.createDataFrame(
        results,
        """workload string, csv_rows bigint, parquet_rows bigint,
           csv_sec double, parquet_sec double, ratio double""",
    )


def mean_ratio(comparison: DataFrame) -> DataFrame:
    """One row: how many times faster Parquet is on average."""
    return comparison.agg(F.round(F.avg("ratio"), 1).alias("mean_ratio"))


def sweep_partitions(
    table: DataFrame,
    workloads: Mapping[str, Workload] = SWEEP_WORKLOADS,
    partitions: Sequence[int] = SWEEP_PARTITIONS,
    repeats: int = 3,
    warm_up: bool = True,
) -> DataFrame:
    """Each workload at each shuffle width with AQE off; ``best`` marks a workload's fastest."""
    spark = table.sparkSession
    results = []
    for name, workload in workloads.items():
        if warm_up:
            run_once(workload(table), [])
        runs = []
        for count in partitions:
            settings = {
                "spark.sql.adaptive.enabled": "false",
                "spark.sql.shuffle.partitions": str(count),
            }
            seconds: list[float] = []
            with sql_settings(spark, settings):
                for _ in range(repeats):
                    rows = run_once(workload(table), seconds)
            runs.append((name, count, rows, median(seconds)))
        fastest = min(run[3] for run in runs)
        results += [(*run, run[3] == fastest) for run in runs]
    return spark.createDataFrame(
        results, "workload string, partitions int, rows bigint, sec double, best boolean"
    )


def time_profiles(
    table: DataFrame,
    profiles: Mapping[str, Mapping[str, str]] = PROFILES,
    workloads: Mapping[str, Workload] = PROFILE_WORKLOADS,
    repeats: int = 3,
    warm_up: bool = True,
) -> DataFrame:
    """Each workload under each profile's SQL settings.

    A count has no keyed shuffle, whose width is what the settings change, so an
    aggregation runs beside it. Master and memory of a profile belong to
    spark-submit: a running JVM keeps its own.
    """
    spark = table.sparkSession
    results = []
    for workload, run in workloads.items():
        if warm_up:
            run_once(run(table), [])
        for name, settings in profiles.items():
            seconds: list[float] = []
            with sql_settings(spark, settings):
                for _ in range(repeats):
                    rows = run_once(run(table), seconds)
            results.append((name, workload, rows, median(seconds)))
    return spark.createDataFrame(
        results, "profile string, workload string, rows bigint, sec double"
    )
