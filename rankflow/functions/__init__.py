"""Column expressions: no function here triggers a job or leaves the JVM."""

from rankflow.functions.arrays import (
    distinct_items,
    first_items,
    join_items,
    pad_items,
    parse_int_list,
)
from rankflow.functions.columns import (
    booking_weight,
    in_year,
    scaled_key,
    suffix_columns,
    text_length,
    with_default,
)
from rankflow.functions.metrics import average_precision
from rankflow.functions.titles import TITLE_GROUPS, TITLE_PATTERN, family_size, passenger_title, regex_lookup

__all__ = [
    "TITLE_GROUPS",
    "TITLE_PATTERN",
    "average_precision",
    "booking_weight",
    "distinct_items",
    "family_size",
    "first_items",
    "in_year",
    "join_items",
    "pad_items",
    "parse_int_list",
    "passenger_title",
    "regex_lookup",
    "scaled_key",
    "suffix_columns",
    "text_length",
    "with_default",
]
