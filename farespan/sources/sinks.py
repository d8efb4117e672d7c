"""Writing results, staging intermediates, and laying out the large tables."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar
from datetime import date, timedelta
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_dir: str | None = None


def _move(spark: SparkSession, source: str, target: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(source).getFileSystem(spark._jsc.hadoopConfiguration()).rename(path(source), path(target))


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def save(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace a result table by write, then swap.

    The new rows are written beside the table first, so a run that fails leaves the table as it
    was, and a report may read the very table it replaces. Between the two renames there is
    a moment without a table; the old one is then under ``<path>._old`` and is put back by the
    next call if the swap was cut off there.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    new, old = f"{path}._new-{uuid.uuid4().hex}", f"{path}._old"
    if _exists(spark, old):
        if not _exists(spark, path):
            _move(spark, old, path)
        else:
            _delete(spark, old)
    try:
        writer = df.write.mode("errorifexists")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(new)
        if _exists(spark, path) and not _move(spark, path, old):
            raise OSError(f"could not move {path} aside")
        if not _move(spark, new, path):
            raise OSError(f"could not move {new} to {path}")
    except BaseException:
        _delete(spark, new)
        if _exists(spark, old) and not _exists(spark, path):
            _move(spark, old, path)
        raise
    _delete(spark, old)


def refresh_days(df: DataFrame, path: str, day: str, first: date, last: date) -> None:
    """Replace the days ``first`` to ``last`` of a result stored by day; other days stay.

    Days with rows are swapped by a dynamic partition overwrite, which moves finished files in
    at its commit; days of the range that have no row any more are removed after it.
    Rows outside the range are refused, as they would replace days that were not asked for.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    with staging_scope():
        rows = stage(df, "refresh")
        days = [r[0] for r in rows.select(F.col(day).cast("date")).distinct().collect()]
        if any(d is None or not first <= d <= last for d in days):
            raise ValueError(f"rows outside {first} to {last}")
        rows.repartition(day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
    for n in range((last - first).days + 1):
        if (d := first + timedelta(days=n)) not in days:
            _delete(spark, f"{path}/{day}={d}")


def save_table(df: DataFrame, name: str) -> None:
    """Replace a catalogue result table, ``catalog.schema.table``."""
    df.write.mode("overwrite").saveAsTable(name)


def export_dim(df: DataFrame, columns: list[str], path: str) -> None:
    save(df.select(*columns), path)


def write_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int) -> None:
    """Store a fact table hashed and sorted by its join keys.

    Segment, leg, charge and fee tables stored with the same ``keys`` and
    ``buckets`` join without moving either side.
    """
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def is_local(master: str) -> bool:
    """Whether driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def staging_dir(spark: SparkSession) -> str:
    """Shared folder the cluster names; a private local one in a local session that names none.

    Executors of a cluster don't see each other's local folders, so there the setting is needed.
    """
    global _local_dir
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if shared:
        return shared.rstrip("/")
    if not is_local(spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="farespan-")
        atexit.register(shutil.rmtree, _local_dir, ignore_errors=True)
    return _local_dir


# ---------------------------------------------------------------- staged frames and their owners

#: Folders staged by the innermost scope that is open; those outside any scope last until the process ends.
_owned: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("owned", default=None)
_loose: list[tuple[SparkSession, str]] = []


def _owner() -> list[tuple[SparkSession, str]]:
    held = _owned.get()
    return _loose if held is None else held


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@atexit.register
def drop_loose() -> None:
    """Delete what was staged outside any scope, or outlived one as part of a result."""
    while _loose:
        with suppress(Exception):  # the session may be gone
            _delete(*_loose.pop())


@contextmanager
def staging_scope() -> Iterator[None]:
    """Owns what is staged inside; deletes it at the end, also after a failure.

    Run the action inside: a frame that reads staged folders is of no use afterwards.
    """
    held: list[tuple[SparkSession, str]] = []
    token = _owned.set(held)
    try:
        yield
    finally:
        _owned.reset(token)
        for each in held:
            _delete(*each)


def _read_by(result: object) -> set[str]:
    """Staged folders that a frame, or one of several, reads."""
    frames = result if isinstance(result, (tuple, list)) else result.values() if isinstance(result, dict) else [result]
    files = (f for df in frames if isinstance(df, DataFrame) for f in df.inputFiles())
    return {m[0] for f in files if (m := re.search(r"[^/]+(?=/[^/]+$)", f))}


def scoped(f: Callable) -> Callable:
    """A function whose staged frames are deleted when it returns or fails, but for those its
    result reads: these pass to the scope around it."""

    @wraps(f)
    def run(*args, **kwargs):
        held: list[tuple[SparkSession, str]] = []
        token, result = _owned.set(held), None
        try:
            result = f(*args, **kwargs)
        finally:
            _owned.reset(token)
            wanted = _read_by(result) if held and result is not None else set()
            for spark, folder in held:
                if folder.rpartition("/")[2] in wanted:
                    _owner().append((spark, folder))
                else:
                    _delete(spark, folder)
        return result

    return run


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate that several branches read, and read it back.

    The copy lives on shared storage, so a lost executor costs no upstream work,
    and each branch reads only the columns it needs. The scope around it owns the copy.
    """
    spark = df.sparkSession
    path = f"{staging_dir(spark)}/farespan-stage/{name}-{uuid.uuid4().hex}"
    _owner().append((spark, path))
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete a staged intermediate before its scope ends, once its readers are done."""
    wanted = _read_by(df)
    held = _owner()
    for each in [x for x in held if x[1].rpartition("/")[2] in wanted]:
        _delete(*each)
        held.remove(each)


def publish(df: DataFrame, path: str | None, name: str) -> DataFrame:
    """A step that is a result table as well: saved under ``path`` and read back for the steps
    after it, so it is computed once. Without a path it is staged."""
    if path is None:
        return stage(df, name)
    save(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
