"""Upsert of newly landed files, each processed once.

The stream's checkpoint remembers which files were taken, where the daily batch selects
yesterday's rows by date and so never sees a row that arrives late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from .. import storage
from ..session import materialize_at, scratch_path
from ..sinks.buckets import upsert_latest
from ..sinks.tables import upsert_into
from ..sinks.upsert import content_hash, dedupe_latest


def upsert_stream(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    path: str,
    keys: list[str],
    order: list[str],
    checkpoint: str,
    slice_by: str | None = None,
    files_per_batch: int = 1_000,
    buckets: int = 64,
) -> StreamingQuery:
    """Upsert the parquet files that have landed since the last run, then stop.

    The last row of a key by ``order`` wins, whatever batch or run it came in: a row never replaces
    one that is later. Rows that ``order`` leaves equal go by a hash of all their columns, so that the table
    is the same for any order of files and any size of batches. The table is in ``buckets`` of its key
    (``sinks.read_buckets``), of which a batch reads those of its keys; with ``slice_by``, a column or expression such
    as a day, it is sliced by that (``sinks.read_table``). A batch that is repeated after a failure finds
    its rows there already and changes nothing. ``checkpoint`` must be in storage that outlives the cluster.
    """
    total = [*order, content_hash(schema)]

    def load(batch: DataFrame, _: int) -> None:
        if batch.isEmpty():
            return
        if slice_by is None:
            upsert_latest(batch, path, keys, buckets, total)
            return
        aside = scratch_path(spark, "batch")
        try:
            latest = materialize_at(dedupe_latest(batch, keys, total), aside)
            upsert_into(latest, path, keys, slice_by, order=total, written=True, unique=True)
        finally:
            storage.delete(spark, aside)

    landed = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    return (
        landed.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
