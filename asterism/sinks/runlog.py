"""The run log: one row per step of a run, appended."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import SparkSession

from ..functions.documents import new_id, now
from ..schemas import RUN_LOG, struct
from .tables import append

# The columns a caller fills in.
GIVEN = "step string, process string, status string, source string, table_name string, error_msg string, n_rows bigint"


def log_run(spark: SparkSession, path: str, rows: list[dict[str, Any]]) -> None:
    """Append run records; id and times are added here."""
    given = struct(GIVEN)
    values = [tuple(row.get(name) for name in given.names) for row in rows]
    records = spark.createDataFrame(values, given)
    records = records.withColumns({"id": new_id(), "etl_date": now(), "create_at": now()})
    append(records.select(struct(RUN_LOG).names), path)


def rejected(n_rows: int) -> str | None:
    """What the log says about rows that a step has rejected; nothing if there are none."""
    return f"{n_rows} rows rejected" if n_rows else None


@contextmanager
def logged(
    spark: SparkSession, path: str | None, step: str, process: str, source: str, table_name: str
) -> Iterator[dict[str, Any]]:
    """Log the block as a success, or as a failure with its message, which is raised again.

    The block may put ``n_rows`` and ``error_msg`` into the record it is given. Without a path,
    nothing is logged.
    """
    record: dict[str, Any] = dict(step=step, process=process, source=source, table_name=table_name)
    if path is None:
        yield record
        return
    try:
        yield record
    except Exception as error:
        log_run(spark, path, [record | {"status": "failed", "error_msg": str(error)}])
        raise
    log_run(spark, path, [record | {"status": "success"}])
