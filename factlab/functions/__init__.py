"""Column functions: calendar fields of epoch and time columns, text conversion, predicates,
fields of JSON texts."""

from factlab.functions.calendar import (
    add_period,
    day_number,
    day_of,
    epoch_to_date,
    month_of,
    within_years,
    year_of,
)
from factlab.functions.predicates import (
    all_of,
    at_least,
    is_true,
    long_text,
    not_null,
    one_of,
)
from factlab.functions.semi_structured import json_columns
from factlab.functions.text import text_to_boolean, text_to_flag

__all__ = [
    "add_period",
    "all_of",
    "at_least",
    "day_number",
    "day_of",
    "epoch_to_date",
    "is_true",
    "json_columns",
    "long_text",
    "month_of",
    "not_null",
    "one_of",
    "text_to_boolean",
    "text_to_flag",
    "within_years",
    "year_of",
]
