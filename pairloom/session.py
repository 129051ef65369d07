"""The shared folder for intermediate and scratch output, and path checks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a new temporary folder, kept in
    the session's configuration so that every later call sees the same one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="pairloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier call has returned."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if the path exists on whichever Hadoop file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def has_data(spark: SparkSession, path: str) -> bool:
    """True for a file, and for a folder that holds a finished write or any data file.

    What an aborted write leaves, an empty folder or one with hidden files only, counts as absent.
    """
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(hadoop_path):
        return False
    if not system.getFileStatus(hadoop_path).isDirectory():
        return True
    names = [status.getPath().getName() for status in system.listStatus(hadoop_path)]
    return "_SUCCESS" in names or any(not name.startswith(("_", ".")) for name in names)


def replace_folder(spark: SparkSession, new: str, target: str) -> None:
    """Puts a finished folder in the place of another, which stays if the move fails."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    source, place, aside = jvm_path(new), jvm_path(target), jvm_path(f"{target}.replaced-{uuid.uuid4().hex}")
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    had = system.exists(place)
    if had and not system.rename(place, aside):
        raise OSError(f"cannot move {target} aside")
    if not system.rename(source, place):
        if had:
            system.rename(aside, place)
        raise OSError(f"cannot move {new} to {target}")
    if had:
        system.delete(aside, True)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this library has written; one that is not there is no error."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for what runs inside; the old value comes back after it."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffles_deleted(spark: SparkSession):
    """For writes: what one has shuffled is deleted when it ends, not when the driver next collects its garbage."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
