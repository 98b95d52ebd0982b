from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from factlab.session import make_session  # noqa: E402
from factlab.sources.scratch import remove_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = make_session(
        "factlab-tests",
        "local[4]",
        {
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    shared = Path(session.conf.get("spark.checkpoint.dir"))
    remove_scratch(session)
    left = list(shared.glob("factlab-*"))
    session.stop()
    assert not left


@pytest.fixture
def skewed_session(spark):
    """Settings under which a few kilobytes count as a skewed partition, and nothing is broadcast."""
    from factlab.benchmarks import sql_settings

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "8",
    }
    with sql_settings(spark, settings):
        yield spark


@pytest.fixture(scope="session")
def hot_table(spark, tmp_path_factory):
    """100,000 rows, a third of them of key 7, stored as Parquet."""
    from pyspark.sql import functions as F

    path = str(tmp_path_factory.mktemp("hot") / "table")
    ids = spark.range(0, 100_000, 1, 8)
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000)
    ids.select(
        hot.alias("key"),
        (F.col("id") % 10).cast("double").alias("score"),
        F.col("id").alias("row_id"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def rows(df) -> list[tuple]:
    """The rows of ``df`` in an order of their own, NULL first."""
    return sorted(
        (tuple(row) for row in df.collect()),
        key=lambda row: tuple((value is not None, value or 0) for value in row),
    )
