"""Text to boolean, in the two readings in use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_to_boolean(text: Column) -> Column:
    """SQL reading: true/t/yes/y/1 and false/f/no/n/0 in any case, NULL for the rest."""
    return F.lower(F.trim(text)).try_cast("boolean")


def text_to_flag(text: Column) -> Column:
    """Strict reading: "true" in any case is true, any other text false, NULL stays NULL."""
    return F.lower(F.trim(text)) == "true"
