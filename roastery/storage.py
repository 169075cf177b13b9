"""Reading and writing tables, and the shared scratch folder."""

from __future__ import annotations

import contextvars
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: How long a replaced snapshot stays for readers that still have it open.
KEEP_HOURS = 24.0
#: File that names the current snapshot of a table.
HEAD = "HEAD"
_local_scratch: dict[str, str] = {}
_scope: contextvars.ContextVar[str | None] = contextvars.ContextVar("scratch_scope", default=None)
Result = TypeVar("Result")


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without that setting gets a folder of its own; a
    cluster session has to name one, because a machine-local folder would be
    lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="roastery-")
    return _local_scratch[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new place for a scratch table, inside the current scope if there is one."""
    folder = _scope.get() or f"{scratch_root(spark)}/roastery"
    return f"{folder}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession, label: str) -> Iterator[None]:
    """Scratch tables made inside are deleted at the end: for runs and batches that recur.

    Nothing lazy that was built on one may be used afterwards.
    """
    folder = scratch_path(spark, label)
    previous = _scope.set(folder)
    try:
        yield
    finally:
        _scope.reset(previous)
        delete_folder(spark, folder)


def materialize(df: DataFrame, label: str, dictionary: bool = True) -> DataFrame:
    """Compute ``df`` once, durably, and return the stored copy.

    A written table rather than a cache: it survives the loss of executors,
    cuts the lineage, and gives later joins real sizes to plan with.  Texts that hardly
    repeat are written faster without a ``dictionary``.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("parquet.enable.dictionary", str(dictionary).lower()).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, jobs: Mapping[str, Callable[[], Result]], at_once: int | None = None) -> dict[str, Result]:
    """Run independent Spark actions at the same time, all or ``at_once`` of them, so that small tables share the cluster."""
    if not jobs:
        return {}
    with ThreadPoolExecutor(max_workers=min(len(jobs), at_once or len(jobs))) as threads:
        started = {
            name: threads.submit(contextvars.copy_context().run, inheritable_thread_target(spark)(job))
            for name, job in jobs.items()
        }
        return {name: future.result() for name, future in started.items()}


def filesystem_of(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    filesystem, hadoop_path = filesystem_of(spark, path)
    return filesystem.exists(hadoop_path)


def delete_folder(spark: SparkSession, path: str) -> None:
    filesystem, hadoop_path = filesystem_of(spark, path)
    filesystem.delete(hadoop_path, True)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True for a completely written table (the commit marker is there)."""
    return path_exists(spark, f"{path}/_SUCCESS")


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``, sorted; metadata only."""
    filesystem, hadoop_path = filesystem_of(spark, path)
    return sorted(status.getPath().getName() for status in filesystem.listStatus(hadoop_path))


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored table; a declared schema saves reading footers and allows an empty table."""
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    cluster_by: str | None = None,
    mode: str = "overwrite",
    touched_partitions_only: bool = False,
) -> int:
    """Write Parquet and return the row count, both in one pass over the data.

    A partitioned write is rebalanced on ``cluster_by`` (the partition column
    unless given): rows of one value meet in few files, whose statistics let
    scans skip the rest, while AQE splits a value that holds a large share of
    all rows over several tasks and files.
    """
    if partition_by:
        cluster = cluster_by or partition_by
        df = df.hint("rebalance", F.col(cluster)).sortWithinPartitions(
            *dict.fromkeys([partition_by, cluster])
        )
    # Counted last: above a shuffle that turns out empty, the count is still there to read.
    rows = Observation()
    writer = df.observe(rows, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if touched_partitions_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return rows.get["rows"]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file in one step: readers find the old text or the new one."""
    jvm = spark.sparkContext._jvm
    filesystem, target = filesystem_of(spark, path)
    aside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = filesystem.create(aside)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    files.rename(filesystem.makeQualified(aside), filesystem.makeQualified(target), options)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file written by ``write_text``; None if there is none."""
    if not path_exists(spark, path):
        return None
    filesystem, hadoop_path = filesystem_of(spark, path)
    source = filesystem.open(hadoop_path)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def _flat(names: list[str]) -> list[str]:
    return [n for n in names if n.startswith("snapshot-")]


def head(spark: SparkSession, path: str) -> tuple[str, str] | None:
    """Folder of the current snapshot below ``path``, and the note stored with it; None if there is no snapshot.

    One read of the head file.  A table written before there was such a file is
    searched for its last complete snapshot.
    """
    text = read_text(spark, f"{path}/{HEAD}")
    if text is not None:
        name, _, note = text.partition("\n")
        return name, note
    if not path_exists(spark, path):
        return None
    for name in reversed(_flat(list_folder(spark, path))):
        if table_exists(spark, f"{path}/{name}"):
            return name, ""
    return None


def snapshots(spark: SparkSession, path: str) -> list[str]:
    """Complete snapshots that are still kept, oldest first: for inspection, since it looks at each."""
    if not path_exists(spark, path):
        return []
    names = list_folder(spark, path)
    found = [n for n in _flat(names) if table_exists(spark, f"{path}/{n}")]
    for hour in (n for n in names if n.startswith("hour=")):
        found += [n for n in _flat(list_folder(spark, f"{path}/{hour}")) if table_exists(spark, f"{path}/{hour}/{n}")]
    return sorted(found)


def completed_at(spark: SparkSession, path: str) -> float:
    """When a complete table got its commit marker, in seconds."""
    filesystem, marker = filesystem_of(spark, f"{path}/_SUCCESS")
    return filesystem.getFileStatus(marker).getModificationTime() / 1000


def _hour(seconds: float) -> str:
    return time.strftime("hour=%Y%m%d%H", time.gmtime(seconds))


def write_snapshot(df: DataFrame, path: str, keep_hours: float = KEEP_HOURS, note: str = "") -> int:
    """Write a small table as its next snapshot; returns its rows.

    Readers go on with the snapshot they have until the head file names this one,
    so a frame may be computed from the very table it is written to, and a run that
    dies leaves the table as it was.  ``note`` is switched together with the snapshot.
    A snapshot stays for ``keep_hours`` at least after it was replaced, however many follow,
    so ``keep_hours`` has to exceed the longest report; frames and views show the table as
    of when they were opened.

    Snapshots lie in folders by hour, which expire as a whole, so a merge reads the head,
    lists the hours that are kept and looks at no other snapshot, however many there are.
    """
    spark = df.sparkSession
    names = list_folder(spark, path) if path_exists(spark, path) else []
    current = head(spark, path)
    taken = [n.rsplit("/", 1)[-1] for n in ([current[0]] if current else []) + _flat(names)]
    number = max((int(n.removeprefix("snapshot-")) for n in taken), default=0) + 1
    hour = max(_hour(time.time()), current[0].split("/")[0] if current and "/" in current[0] else "")
    name = f"{hour}/snapshot-{number:012d}"
    rows = write_table(df.hint("rebalance"), f"{path}/{name}")
    write_text(spark, f"{path}/{HEAD}", f"{name}\n{note}")
    _expire(spark, path, names, name, keep_hours)
    return rows


def _expire(spark: SparkSession, path: str, names: list[str], current: str, keep_hours: float) -> None:
    """Delete what was replaced ``keep_hours`` ago or earlier.

    Everything in an hour's folder was replaced before the next folder's hour was over.
    """
    if keep_hours <= 0:
        for hour in [n for n in names if n.startswith("hour=")]:
            for old in list_folder(spark, f"{path}/{hour}"):
                if f"{hour}/{old}" != current:
                    delete_folder(spark, f"{path}/{hour}/{old}")
    hours = sorted({n for n in names if n.startswith("hour=")} | {current.split("/")[0]})
    limit = _hour(time.time() - 3600 * (keep_hours + 1))
    for old, successor in zip(hours, hours[1:]):
        if successor < limit:
            delete_folder(spark, f"{path}/{old}")
    flat = _flat(names)  # of before there were hours; the last was replaced by the first hour's first
    replaced = flat if keep_hours <= 0 or (hours[0] < limit) else []
    for old in replaced:
        delete_folder(spark, f"{path}/{old}")


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The latest complete snapshot."""
    current = head(spark, path)
    if current is None:
        raise FileNotFoundError(f"no complete snapshot under {path}")
    return read_table(spark, f"{path}/{current[0]}", schema)
