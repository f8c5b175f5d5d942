"""Session settings the library expects; callers may bring their own session."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Wall-clock columns are compared as written, text casts must fail loudly, and the
# physical strategy (broadcast, skew splits, partition counts) is left to AQE.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Keyed stream state lies on disk and in the checkpoint folder, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # The JVM does not compile generated methods over this size; marts are wide enough
    # to exceed it, and split projections are compiled where one huge method is not.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(
    app_name: str = "lakemart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def keep_methods_compiled(spark: SparkSession) -> None:
    """Gives a caller's session the library's limit on generated methods, unless its own is lower.

    Staging and marts project dozens of expressions a row.  Generated as one method over 8,000 bytes they are never
    compiled by the JVM but interpreted, at several times the CPU time.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name, "65535")) > int(SETTINGS[name]):
        spark.conf.set(name, SETTINGS[name])


def keep_tasks_small(spark: SparkSession) -> None:
    """Has the session shuffle to four times its number of partitions, and read them together up to 16 MB, unless it names its own.

    Staging spells rows out to several times their width and marts shuffle and sort them so; where a task takes 64 MB of
    narrow rows, or a partition is as large as 200 of them make it, these do not fit a task's share of memory and spill.
    """
    partitions = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    }
    for name, value in wanted.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A machine-local folder is used only where the session runs in one process and
    names none (tests, laptops); on a cluster a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="lakemart-")
    spark.conf.set("spark.checkpoint.dir", local)
    return os.path.abspath(local)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries run inside the block leave no shuffle files: they go when a query ends, not when the driver collects garbage.

    A DataFrame that is run twice shuffles twice, as it would have without this where its plan is made anew.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


_recording: list[list[str]] = []


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The folders that ``written`` makes inside the block, for a caller who knows when they are read no more."""
    folders: list[str] = []
    _recording.append(folders)
    try:
        yield folders
    finally:
        _recording.remove(folders)


def written(df: DataFrame, compact: bool = False) -> tuple[DataFrame, str]:
    """``df`` written once under a new name in the shared folder, read from there, and the folder it lies in.

    A ``compact`` table takes less disk for some CPU time, and what was shuffled to make it goes when it is written.
    """
    path = f"{shared_folder(df.sparkSession)}/lakemart-tables/{uuid.uuid4().hex}"
    for folders in _recording:
        folders.append(path)
    if compact:
        with shuffles_dropped(df.sparkSession):
            df.write.option("compression", "zstd").parquet(path)
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of ``written`` that nothing reads any more, on whatever store it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, compact: bool = False) -> DataFrame:
    """Writes a DataFrame once as a table in the shared folder and reads it from there.

    For results that are read several times by one plan and are far smaller than what
    they come from.  The files outlive executors, so losing one repeats nothing, and
    the next plan sees their real size.
    """
    return written(df, compact)[0]
