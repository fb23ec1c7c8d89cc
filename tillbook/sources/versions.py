"""Tables that are rebuilt whole: versioned folders behind one pointer file.

A rebuild writes a new version beside the one that readers use, and swaps the
pointer when Spark's committer has finished:

    <table>/v-<time>-<run>/part-*.parquet     every version, whole
    <table>/_current                          the name of the version in use

The swap is one rename over the old pointer, which file systems do at once, so
a reader gets the old table or the new one and never half of either; a run
that dies leaves a folder that no pointer names.  Two rebuilds at a time both
write whole versions, and the later swap stands.  ``prune`` deletes versions
that nobody can be about to read: the newest ``keep`` stay, and so does the one in use.
"""

from __future__ import annotations

import time
import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"
VERSION_PREFIX = "v-"


def _path(spark: SparkSession, path: str) -> JavaObject:
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str) -> JavaObject:
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def replace_file(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file over another one, which goes if it is there."""
    fs = spark._jvm.org.apache.hadoop.fs
    context = fs.FileContext.getFileContext(_file_system(spark, target).getUri(), spark._jsc.hadoopConfiguration())
    options = spark._sc._gateway.new_array(getattr(fs, "Options$Rename"), 1)
    options[0] = getattr(fs, "Options$Rename").OVERWRITE
    context.rename(_path(spark, source), _path(spark, target), options)


def make_folder(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).mkdirs(_path(spark, path))


def only_file(spark: SparkSession, folder: str) -> str:
    """The one Parquet file of a folder that one task wrote."""
    names = [s.getPath().toString() for s in _file_system(spark, folder).listStatus(_path(spark, folder)) if s.getPath().getName().endswith(".parquet")]
    if len(names) != 1:
        raise ValueError(f"{folder} has {len(names)} files")
    return names[0]


def current(spark: SparkSession, table: str) -> str | None:
    """Folder of the version in use; None before the first one."""
    pointer = f"{table.rstrip('/')}/{POINTER}"
    files = _file_system(spark, pointer)
    if not files.exists(_path(spark, pointer)):
        return None
    stream = files.open(_path(spark, pointer))
    try:
        name = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return f"{table.rstrip('/')}/{name.strip()}"


def read_current(spark: SparkSession, table: str) -> DataFrame:
    folder = current(spark, table)
    if folder is None:
        raise FileNotFoundError(f"{table} has no whole version yet")
    return spark.read.parquet(folder)


def point_to(spark: SparkSession, table: str, name: str) -> None:
    """Makes a whole version the one in use."""
    table = table.rstrip("/")
    fresh = f"{table}/_pointer-{uuid.uuid4().hex}"
    stream = _file_system(spark, table).create(_path(spark, fresh), True)
    try:
        stream.write(bytearray(name.encode()))
    finally:
        stream.close()
    replace_file(spark, fresh, f"{table}/{POINTER}")


def publish(df: DataFrame, table: str, partition_by: list[str] | None = None) -> str:
    """Writes ``df`` as the table's next version, puts it to use, and returns its folder."""
    spark, table = df.sparkSession, table.rstrip("/")
    name = f"{VERSION_PREFIX}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    if partition_by:
        # rows of a value meet in as many tasks as their size needs, so a value is a few files, not one per task
        df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(f"{table}/{name}")
    else:
        df.write.parquet(f"{table}/{name}")
    point_to(spark, table, name)
    return f"{table}/{name}"


def versions(spark: SparkSession, table: str) -> list[str]:
    """Names of all versions, whole or not, oldest first."""
    files = _file_system(spark, table)
    if not files.exists(_path(spark, table)):
        return []
    names = [s.getPath().getName() for s in files.listStatus(_path(spark, table)) if s.isDirectory()]
    return sorted(n for n in names if n.startswith(VERSION_PREFIX))


def prune(spark: SparkSession, table: str, keep: int = 2) -> list[str]:
    """Deletes versions older than the one in use, but for the ``keep`` - 1 newest of them; returns what went.

    Newer folders than the one in use belong to a rebuild that is still running (or died) and stay until the next
    swap makes them old."""
    used = current(spark, table)
    if used is None:
        return []
    older = [n for n in versions(spark, table) if n < used.rsplit("/", 1)[1]]
    gone = older[: max(0, len(older) - max(0, keep - 1))]
    files = _file_system(spark, table)
    for name in gone:
        files.delete(_path(spark, f"{table.rstrip('/')}/{name}"), True)
    return gone
