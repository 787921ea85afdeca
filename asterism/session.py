"""Session settings, and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from pathlib import Path
from threading import Lock, local
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import storage

#: Of tables between steps and of versions, each written once and read a few times.
COMPRESSION = "zstd"

#: Tells Spark to delete the shuffle files of a query once it is through, and not when the driver next collects its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_FOLDERS: dict[str, str] = {}
_SHIPPED: set[str] = set()
_SCOPES = local()
_WRITING: dict[str, int] = {}
_WRITING_LOCK = Lock()


def build_session(app: str = "asterism", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Partition counts, memory and the checkpoint folder belong to the cluster and are
    left to its configuration or to ``conf``, given as ``**{"spark.x.y": "z"}``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables, deleted when the application ends.

    It is in the folder that the cluster names in ``spark.checkpoint.dir``. Only a local-mode
    session may fall back to a folder of this machine; on a cluster the executors could not
    see it, so a missing setting is an error there.
    """
    app_id = spark.sparkContext.applicationId
    if app_id not in _FOLDERS:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="asterism-")
        path = f"{shared.rstrip('/')}/asterism-{app_id}"
        storage.make_folder(spark, path, until_exit=True)
        _FOLDERS[app_id] = path
    return _FOLDERS[app_id]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the scratch folder that no other call gets."""
    path = f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"
    for scope in getattr(_SCOPES, "open", [])[-1:]:
        scope.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables that this thread makes within, once it is through.

    Only for work whose results have been written elsewhere by then.
    """
    scopes = _SCOPES.__dict__.setdefault("open", [])
    scopes.append([])
    try:
        yield
    finally:
        for path in scopes.pop():
            storage.delete(spark, path)


def observed(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """``df``, and aggregates of it that are known once a write of it has run.

    Without arguments, the number of rows as ``n_rows``. Saves a second pass for counting.
    """
    seen = Observation()
    counts = counts or {"n_rows": F.count(F.lit(1))}
    return df.observe(seen, *[column.alias(name) for name, column in counts.items()]), seen


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes that begin within leave no shuffle files. A session that has a setting of its own keeps it."""
    app = spark.sparkContext.applicationId
    with _WRITING_LOCK:
        ours = app in _WRITING or spark.conf.get(DROP_SHUFFLES, None) is None
        if ours:
            _WRITING[app] = _WRITING.get(app, 0) + 1
            spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _WRITING_LOCK:
            if ours:
                _WRITING[app] -= 1
                if not _WRITING[app]:  # the last of those that write side by side
                    del _WRITING[app]
                    spark.conf.unset(DROP_SHUFFLES)


def materialize_at(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to a path of the shared folder and read it back. What was shuffled for it is not needed any more."""
    with _shuffles_dropped(df.sparkSession):
        df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage and freezes row placement, so that a lost executor costs a re-read
    of the table and never a recomputation that could come out in another order.
    """
    return materialize_at(df, scratch_path(df.sparkSession, label))


def run_all(spark: SparkSession, tasks: Sequence[Callable[[], Any]], at_once: int = 4) -> list[Any]:
    """The results of independent pieces of work, run side by side in this session.

    Small tables then share the cluster; jobs of large ones queue as they would anyway.
    """
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(lambda task: task(), [inheritable_thread_target(spark)(task) for task in tasks]))


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables now; for long sessions, once their results are written."""
    storage.delete(spark, scratch_folder(spark))


def ship_package(spark: SparkSession) -> None:
    """Make sure that Python tasks can import this package, wherever the driver was started.

    Spark's file server brings an archive of it to the executors, unless they have it in their path.
    """
    package = Path(__file__).resolve().parent
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED and str(package.parent) not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        folder = tempfile.mkdtemp()  # executors fetch the archive from the driver as they start
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, package.name), "zip", package.parent, package.name))
    _SHIPPED.add(app)
