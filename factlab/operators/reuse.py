"""Keeping a result that several queries read."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def shared(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` from its first use to the end of the block.

    Blocks that do not fit memory go to disk, and those of a lost executor are
    computed again from the source.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
