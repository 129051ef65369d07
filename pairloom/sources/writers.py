"""Writing raw tables and splits, reusing them, and reporting their size."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession, functions as F

from pairloom.session import delete_folder, path_exists, replace_folder, setting, shuffles_deleted
from pairloom.sources.readers import ARRAY_HEAD, ARRAY_SEPARATOR, ARRAY_TAIL
from pairloom.sources.versions import commit, current, entry, new_version

SPLITS = ("train", "val", "test")

# Of parquet; text takes about two thirds of what it takes with Spark's default.
CODEC = "zstd"


def _with_options(writer: DataFrameWriter, fmt: str) -> DataFrameWriter:
    if fmt == "json":
        return writer.option("ignoreNullFields", False)
    return writer.option("compression", CODEC) if fmt == "parquet" else writer


def write_raw(df: DataFrame, path: str, fmt: str = "json", versioned: bool = False) -> int:
    """Overwrites ``path`` and returns the number of rows, counted by the writing job itself.

    The rows go to a new folder beside it, which takes its place when all are written: a write that
    fails leaves what was there. JSON comes out as lines, with non-ASCII characters as they are and null fields kept.

    ``versioned`` makes the change all at once (``versions``), where a plain folder is absent between two renames.
    Such a table is read by the functions of this library, or from ``versions.current(spark, path)``.
    """
    seen = Observation()
    spark, path = df.sparkSession, path.rstrip("/")
    beside = new_version(path) if versioned else f"{path}.new-{uuid.uuid4().hex}"
    writer = _with_options(df.observe(seen, F.count(F.lit(1)).alias("n")).write, fmt)
    try:
        writer.format(fmt).save(beside)
        if versioned:
            commit(spark, path, beside, rows=seen.get["n"], format=fmt)
        else:
            replace_folder(spark, beside, path)
    except Exception:
        delete_folder(spark, beside)
        raise
    return seen.get["n"]


def write_json_arrays(df: DataFrame, path: str, indented: bool = True) -> None:
    """Overwrites ``path`` with one JSON array per task, for tools that read whole arrays.

    Records are rendered by Spark, brackets and commas too; the helper hands batches on as they are and adds the
    closing bracket. Without ``indented`` an array stands on one line.
    """
    record = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    write_json_texts(df.select(record.alias("value")), path, indented)


def write_json_texts(records: DataFrame, path: str, indented: bool = False) -> None:
    """``write_json_arrays`` of records (objects) that are JSON text already, in the only column."""
    record = F.col(records.columns[0])
    inner = record if not indented else F.concat(F.lit("    "), F.substr(record, F.lit(2), F.length(record) - 2))
    # The text writer ends every row with the line break that head, separator and tail start or end with, so
    # it is left out here.
    head, between, tail = (ARRAY_HEAD, ARRAY_SEPARATOR, ARRAY_TAIL) if indented else ("[", ",", "]")
    between, tail = between.removeprefix("\n"), tail.removeprefix("\n")
    # Row numbers start with 0 in every task, in the bits below the task's.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0

    # Defined here so that it is sent to the executors whole, wherever the package is installed.
    def close(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started = False
        for batch in batches:
            started = started or batch.num_rows > 0
            yield batch
        if started:
            yield pa.RecordBatch.from_arrays([pa.array([tail], batch.schema.types[0])], schema=batch.schema)

    opened = records.select(F.concat(F.when(first, F.lit(head)).otherwise(F.lit(between)), inner).alias("value"))
    writer = opened.mapInArrow(close, "value string").write.mode("overwrite")
    (writer if indented else writer.option("lineSep", " ")).text(path)


def write_splits(df: DataFrame, folder: str, fmt: str = "parquet", versioned: bool = False) -> None:
    """Overwrites ``folder`` with one subfolder per split; ``versioned`` as in ``write_raw``.

    Rows are written where they are. After ``assign_split`` a task holds one stretch of
    ``split_pos``, so it writes one file (two or three at a boundary between splits) in that
    order, and the row range of every file is known from its statistics.
    """
    target = new_version(folder) if versioned else folder
    writer = _with_options(df.write.mode("overwrite").partitionBy("split"), fmt)
    try:
        # With one open file per split Spark need not sort the rows by split first, which would be a
        # second sort of whole rows. Beyond this many splits it goes back to sorting.
        with shuffles_deleted(df.sparkSession), setting(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", "8"):
            writer.format(fmt).save(target)
        if versioned:
            commit(df.sparkSession, folder, target, format=fmt)
    except Exception:
        if versioned:
            delete_folder(df.sparkSession, target)
        raise


def materialise_if_absent(
    spark: SparkSession, folder: str, build: Callable[[], DataFrame], fmt: str = "parquet", versioned: bool = False
) -> str:
    """Writes the splits that ``build`` returns, unless a finished write is already there."""
    if entry(spark, folder) is None and not path_exists(spark, f"{folder}/_SUCCESS"):
        write_splits(build(), folder, fmt, versioned)
    return folder


def split_file_report(
    spark: SparkSession, folder: str, names: Sequence[str] = SPLITS
) -> DataFrame:
    """``split, present, n_files, size_mb`` for each expected split.

    The binary source is asked for path and length only, so no file is opened.
    """
    split = F.regexp_extract("path", r"/split=([^/]+)/", 1)
    folder = current(spark, folder)
    if path_exists(spark, folder):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    else:
        files = spark.createDataFrame([], "path string, length long")
    sizes = (
        files.groupBy(split.alias("split"))
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))
    )
    one = spark.range(1, numPartitions=1)
    expected = one.select(F.explode(F.array(*map(F.lit, names))).alias("split"))
    return expected.join(sizes, "split", "left").select(
        "split",
        F.col("n_files").isNotNull().alias("present"),
        F.coalesce("n_files", F.lit(0)).alias("n_files"),
        F.round(F.col("n_bytes") / (1024 * 1024), 2).alias("size_mb"),
    )
