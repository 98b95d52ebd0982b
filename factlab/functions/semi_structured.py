"""Typed columns from a column of JSON texts, with a record of what does not fit."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOT_JSON = "not json"


def json_columns(
    df: DataFrame,
    column: str,
    fields: Mapping[str, tuple[str, str]],
    problems: str = "problems",
) -> DataFrame:
    """``df`` with a column for each of ``fields`` (name: path and type) and ``problems``.

    Paths are like ``$.a.b[0]``. A field is NULL where the text is NULL, the path is absent,
    the value is a JSON null, or the value does not convert. ``problems`` is an array of
    strings: ``not json`` for a text that does not parse, else the names of the fields whose
    value is there and does not convert; empty for a row that fits. A row is never dropped.
    Only fields that a reader of the result takes are extracted.
    """
    text = F.col(column)
    parsed = F.try_parse_json(text)
    added, wrong = {}, [F.when(text.isNotNull() & parsed.isNull(), F.lit(NOT_JSON))]
    for name, (path, kind) in fields.items():
        value = F.try_variant_get(parsed, path, kind)
        added[name] = value
        wrong.append(F.when(_given(parsed, path) & value.isNull(), F.lit(name)))
    return df.withColumns({**added, problems: F.array_compact(F.array(*wrong))})


def _given(parsed: Column, path: str) -> Column:
    """Whether there is a value other than a JSON null at ``path``."""
    found = F.try_variant_get(parsed, path, "variant")
    return found.isNotNull() & ~F.is_variant_null(found)
