"""Column expressions; all of them stay inside Spark's generated code."""

from areacast.functions.dates import date_key, parse_date, week_key_calendar, week_key_iso
from areacast.functions.text import (
    compose_label,
    concat_key,
    decimal_comma,
    fold_accents,
    is_reject,
    label_area,
    label_station,
    name_or_unknown,
    to_decimal_comma,
)

__all__ = [
    "compose_label",
    "concat_key",
    "date_key",
    "decimal_comma",
    "fold_accents",
    "is_reject",
    "label_area",
    "label_station",
    "name_or_unknown",
    "parse_date",
    "to_decimal_comma",
    "week_key_calendar",
    "week_key_iso",
]
