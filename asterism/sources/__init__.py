"""Readers: files, JSON payloads, JDBC tables, increments and table listings."""

from .catalog import catalog_columns, list_catalog_tables, list_tables, scan_tables
from .files import all_empty, is_empty, read_csv_inferred, read_csv_raw, read_json_records, read_or_none
from .increments import date_range, extract_increment, snapshot_diff
from .jdbc import hash_predicates, jdbc_options, quantile_query, read_jdbc, stride_bounds, stride_predicates

__all__ = [
    "all_empty",
    "catalog_columns",
    "date_range",
    "extract_increment",
    "hash_predicates",
    "is_empty",
    "jdbc_options",
    "list_catalog_tables",
    "list_tables",
    "quantile_query",
    "read_csv_inferred",
    "read_csv_raw",
    "read_jdbc",
    "read_json_records",
    "read_or_none",
    "scan_tables",
    "snapshot_diff",
    "stride_bounds",
    "stride_predicates",
]
