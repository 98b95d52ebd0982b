"""Where a query may write a table of its own, and the end of such tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

_written: list[tuple[SparkSession, str]] = []


@cache
def _local_folder() -> tempfile.TemporaryDirectory:
    # Kept to the end of the process, which removes it.
    return tempfile.TemporaryDirectory(prefix="factlab-")


def fresh_path(spark: SparkSession, label: str) -> str:
    """An unused path in the shared folder that ``spark.checkpoint.dir`` names.

    Only a local session may do without that setting: on a cluster the
    executors do not see the driver's own disk. What is written there stays for
    the results that read it, until ``remove_scratch`` or the end of the process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_folder().name
    path = f"{base.rstrip('/')}/factlab-{label}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Removes one fresh path of ``spark``, which no result reads any more."""
    _written.remove((spark, path))
    _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    # After the end of a session its context is another object, or the bare class.
    if getattr(context, "_jsc", None) is not None:
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def remove_scratch(spark: SparkSession | None = None) -> None:
    """Removes what was written to fresh paths, of ``spark`` or of every session.

    Results that still read such a path fail afterwards. A session that has ended
    cannot remove its tables any more; they are left to the owner of the folder.
    """
    for owner, path in [x for x in _written if spark is None or x[0] is spark]:
        _written.remove((owner, path))
        _delete(owner, path)


atexit.register(remove_scratch)
