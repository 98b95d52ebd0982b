"""SQL options for a session, and a shuffle width that follows the input size."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# All of these can be set on a running session; memory, master and serializer
# belong to spark-submit.
SQL_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.mergeSchema": "false",
    "spark.sql.autoBroadcastJoinThreshold": str(50 * 1024 * 1024),
}


def make_session(
    app: str, master: str | None = None, options: Mapping[str, str] | None = None
) -> SparkSession:
    """A session with ``SQL_OPTIONS`` and any further ``options``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_OPTIONS, **(options or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_options(
    input_bytes: int, cores: int, partition_bytes: int = 128 << 20
) -> dict[str, str]:
    """Shuffle options for an exchange of about ``input_bytes``.

    AQE merges partitions that turn out small but never adds any, so the count
    has to start from the full input: 100 TB at 128 MB is some 800,000
    partitions. Choose larger ``partition_bytes`` to bound the shuffle's blocks.
    """
    count = max(cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(count),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
    }
