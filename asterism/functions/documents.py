"""JSON documents, generated ids and load times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_doc(**fields: Column | str) -> Column:
    """A document with the given fields, in that order."""
    return F.struct(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items()])


def merge_docs(*docs: Column) -> Column:
    """One map of several with distinct keys, such as the per-column entries of a profile."""
    return F.map_concat(*docs)


def to_json_text(col: Column | str) -> Column:
    return F.to_json(col)


def now() -> Column:
    """Load time of the query, without zone."""
    return F.current_timestamp().cast("timestamp_ntz")


def new_id() -> Column:
    return F.uuid()
