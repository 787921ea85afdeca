"""Writers: CSV and JSON files, increments, upserted tables, appended tables, the run log."""

from .buckets import buckets_of, read_buckets, upsert_buckets
from .files import increment_path, read_increment, write_csv, write_increment, write_increments, write_json
from .runlog import log_run, logged
from .tables import (
    ConcurrentWrite,
    append,
    drop_old_versions,
    ensure_table,
    latest_version,
    read_table,
    target_name,
    upsert_into,
    upsert_path,
    write_version,
)
from .upsert import DuplicateKeys, assert_unique, content_hash, dedupe_latest, duplicate_keys, upsert

__all__ = [
    "ConcurrentWrite",
    "DuplicateKeys",
    "append",
    "buckets_of",
    "assert_unique",
    "content_hash",
    "dedupe_latest",
    "drop_old_versions",
    "duplicate_keys",
    "ensure_table",
    "increment_path",
    "latest_version",
    "log_run",
    "logged",
    "read_buckets",
    "read_increment",
    "read_table",
    "target_name",
    "upsert",
    "upsert_buckets",
    "upsert_into",
    "upsert_path",
    "write_csv",
    "write_increment",
    "write_increments",
    "write_json",
    "write_version",
]
