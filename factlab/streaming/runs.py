"""File streams that run until all files which have arrived are read, and then stop."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

#: Seconds between looks at the progress; a query keeps that of its last 100 batches.
_LOOK = 0.5


class Progress(NamedTuple):
    """Of one run: batches, rows read, and rows dropped as later than the watermark.

    ``late`` counts rows where the first state is that of ``stream_windows(once=)``, and
    else partial groups of rows, which is what the state's tasks see.
    """

    batches: int
    rows: int
    late: int


def file_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """The Parquet files at ``path``, a folder or one file, as a stream.

    ``files_per_batch`` bounds a batch, so that a backlog is read in several; files are
    read in the order of their time of change. By default a batch is all that has arrived.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # The source takes a folder or a pattern; as a pattern one file will do as well.
    return reader.parquet(f"{path.rstrip('/')}*")


def run_available(result: DataFrame, path: str, checkpoint: str) -> Progress:
    """Adds what ``result`` gives for all files that have arrived to the Parquet at ``path``.

    Runs until these are read. ``checkpoint`` holds what was read, the state and the
    watermark: a later run, also after one that died, goes on from there, and the sink's
    log lets no batch count twice. Both paths must be shared by all executors.
    """
    query = (
        result.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path, format="parquet")
    )
    seen = {}
    try:
        ended = False
        while not ended:
            ended = query.awaitTermination(_LOOK)
            for batch in query.recentProgress:
                seen[batch["batchId"]] = batch
    finally:
        query.stop()
    late = sum(_late(batch["stateOperators"]) for batch in seen.values())
    return Progress(len(seen), sum(batch["numInputRows"] for batch in seen.values()), late)


def _late(states: list[dict]) -> int:
    """Of states in a row the one nearest the source, listed last, sees the late rows."""
    return states[-1]["numRowsDroppedByWatermark"] if states else 0
