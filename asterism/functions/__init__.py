"""Column functions: casting, cleaning, dates, quality labels and JSON documents."""

from .casting import (
    day_before,
    parse_date,
    parse_keys,
    read_as,
    to_bool,
    to_decimal,
    to_int,
    to_text,
    to_ts,
    type_name,
)
from .cleaning import clean_newlines, clean_newlines_nested
from .documents import json_doc, merge_docs, new_id, now, to_json_text
from .quality import pct, quality_label

__all__ = [
    "clean_newlines",
    "clean_newlines_nested",
    "day_before",
    "json_doc",
    "merge_docs",
    "new_id",
    "now",
    "parse_date",
    "parse_keys",
    "pct",
    "quality_label",
    "read_as",
    "to_bool",
    "to_decimal",
    "to_int",
    "to_json_text",
    "to_text",
    "to_ts",
    "type_name",
]
