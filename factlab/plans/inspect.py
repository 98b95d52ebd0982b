"""Plan text, for people and for tests."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain(mode=mode)`` prints; ``extended`` includes the logical plans."""
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        df.explain(mode=mode)
    return printed.getvalue()
