"""Tables that change all at once: data in a folder of its own, and a log that names the one that counts.

A write puts its files into a new folder, then adds the next entry to the log: a small file that gets its number by
one rename, as the last step. Readers take the entry of the highest number, so they see the old table or the new
one at any moment, and a write that stops anywhere leaves the old one. Data is never renamed, which matters
where a store copies instead. One writer at a time; what is older than the entries kept is deleted after a
commit, so a reader has until then to finish.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from pairloom.session import delete_folder

LOG = "_log"
DATA = "_data-"
# Entries, and their data, that a commit leaves in place.
KEPT = 2


def _system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _names(spark: SparkSession, folder: str) -> list[str]:
    system, path = _system(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(path)) if system.exists(path) else []


def _entries(spark: SparkSession, path: str) -> list[str]:
    return [name for name in _names(spark, f"{path}/{LOG}") if name.isdigit()]


def _read(spark: SparkSession, file: str) -> dict:
    system, path = _system(spark, file)
    stream = system.open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def entry(spark: SparkSession, path: str) -> dict | None:
    """What the last commit noted, or none for a folder that is no versioned table."""
    path = path.rstrip("/")
    entries = _entries(spark, path)
    return _read(spark, f"{path}/{LOG}/{entries[-1]}") if entries else None


def current(spark: SparkSession, path: str) -> str:
    """The folder to read: the last version's, or the path itself if it is a plain one."""
    last = entry(spark, path)
    return path if last is None else f"{path.rstrip('/')}/{last['data']}"


def new_version(path: str) -> str:
    """The folder for a version's data; it counts for nothing until it is committed."""
    return f"{path.rstrip('/')}/{DATA}{uuid.uuid4().hex}"


def commit(spark: SparkSession, path: str, folder: str, kept: int = KEPT, **notes: object) -> None:
    """Makes the data in ``folder`` (from ``new_version``, completely written) the table's."""
    path = path.rstrip("/")
    entries = _entries(spark, path)
    number = int(entries[-1]) + 1 if entries else 1
    log = f"{path}/{LOG}"
    system, begun = _system(spark, f"{log}/.{uuid.uuid4().hex}")
    stream = system.create(begun)
    stream.write(bytearray(json.dumps({"data": folder.rpartition("/")[2], **notes}).encode()))
    stream.close()
    _, place = _system(spark, f"{log}/{number:020d}")
    if system.exists(place) or not system.rename(begun, place):
        system.delete(begun, False)
        raise OSError(f"another write has committed version {number} of {path}")
    clean(spark, path, kept)


def clean(spark: SparkSession, path: str, kept: int = KEPT) -> None:
    """Deletes all but the last entries and their data, and what writes that stopped have left."""
    path = path.rstrip("/")
    entries = _entries(spark, path)
    held = {_read(spark, f"{path}/{LOG}/{name}")["data"] for name in entries[-kept:]}
    # Entries go before their data, so that none ever names a folder that is gone.
    for name in _names(spark, f"{path}/{LOG}"):
        if name not in entries[-kept:]:
            delete_folder(spark, f"{path}/{LOG}/{name}")
    for name in _names(spark, path):
        if name.startswith(DATA) and name not in held:
            delete_folder(spark, f"{path}/{name}")
