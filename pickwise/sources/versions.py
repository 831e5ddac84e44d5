"""Model tables in immutable versions behind a pointer.

A table is a folder with ``versions/<id>/`` (each written once, never changed) and the file
``CURRENT``, which names the version in use. ``publish`` writes a new version and then
replaces the pointer by one atomic rename; a job that dies before that leaves the old version in use. A reader
resolves the pointer once and then works on that version's files, so a version published meanwhile neither
mixes into its result nor takes its files away; ``retire`` deletes old versions, but never the newest few
before the one in use.

The pointer's rename is atomic on HDFS and local file systems. On an object store without atomic rename,
put the tables' root on a file system that has one."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

POINTER, VERSIONS = "CURRENT", "versions"


def hadoop_path(spark: SparkSession, path: str) -> tuple:
    """(path, file system) of a path of any Hadoop file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_small(spark: SparkSession, path: str) -> str | None:
    """Text of a small file; None if there is no such file."""
    p, fs = hadoop_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_small(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place of another (or of none): readers see the old or the new text, whole."""
    jvm = spark.sparkContext._jvm
    draft, fs = hadoop_path(spark, f"{path}-{uuid.uuid4().hex}.tmp")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(draft, jvm.org.apache.hadoop.fs.Path(path), overwrite)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; no such folder: none."""
    p, fs = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def versions(spark: SparkSession, table: str) -> list[str]:
    """Ids of the versions that exist, oldest first (unfinished ones included)."""
    return folder_names(spark, f"{table}/{VERSIONS}")


def current_version(spark: SparkSession, table: str) -> str:
    """Id of the version in use."""
    version = read_small(spark, f"{table}/{POINTER}")
    if version is None:
        raise FileNotFoundError(f"no version of {table} has been published")
    return version


def current_path(spark: SparkSession, table: str) -> str:
    """Folder of the version in use."""
    return f"{table}/{VERSIONS}/{current_version(spark, table)}"


def publish(spark: SparkSession, table: str, write: Callable[[str], None]) -> str:
    """Write a new version with ``write(folder)`` and put it in use; returns its id. Of jobs that
    publish at the same time, the one that ends last is in use."""
    taken = versions(spark, table)
    number = 1 + max((int(v.split("-")[0]) for v in taken), default=0)
    version = f"{number:08d}-{uuid.uuid4().hex[:8]}"
    write(f"{table}/{VERSIONS}/{version}")
    replace_small(spark, f"{table}/{POINTER}", version)
    return version


def retire(spark: SparkSession, table: str, keep: int = 2) -> list[str]:
    """Delete versions older than the one in use but for the newest ``keep`` of them; returns the deleted ids.
    ``keep`` has to cover the readers that may still be at work on an earlier version."""
    now = current_version(spark, table)
    older = [v for v in versions(spark, table) if v < now]
    gone = older[:-keep] if keep else older
    for version in gone:
        p, fs = hadoop_path(spark, f"{table}/{VERSIONS}/{version}")
        fs.delete(p, True)
    return gone
