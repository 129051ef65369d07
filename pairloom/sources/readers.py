"""Reading datasets together with the order of their rows.

A DataFrame has no order, so each scan adds two columns that give it back: ``part``, the file (or
block of a file) as sortable text, and ``pos``, the row's place within it. Sorting by ``part, pos``
yields the stored order; no shuffle or driver-side count is needed to fill either column.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from pairloom.functions.text import as_text
from pairloom.session import delete_folder, has_data, new_folder
from pairloom.sources.arrays import read_elements
from pairloom.sources.versions import current, entry

log = logging.getLogger(__name__)

PART = "part"
POS = "pos"

# --- Fixed values: layout of a JSON array of objects written with an indent of two -------------
ARRAY_HEAD = "[\n  {\n"
ARRAY_SEPARATOR = "\n  },\n  {\n"
ARRAY_TAIL = "\n  }\n]"
# ----------------------------------------------------------------------------------------------

# Parts whose offsets are broadcast at once; each takes its path and some 20 bytes.
BROADCAST_PARTS = 65_536

SPLIT_SCHEMA = T.StructType(
    [
        T.StructField("split_pos", T.LongType()),
        T.StructField("split_row", T.LongType()),
        T.StructField("instruction", T.StringType()),
        T.StructField("response", T.StringType()),
        T.StructField("split", T.StringType()),
    ]
)


def scan(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    landed: bool = False,
    **options: str,
) -> DataFrame:
    """All rows of a dataset with ``part`` and ``pos``.

    Parquet knows each row's index in its file. The other formats are ordered by file, offset of
    the file block, and order of reading within the block. ``landed`` says that the table was written
    with both columns, as ``collect`` does, and that they are its order. Otherwise columns that a
    dataset happens to have under these names are an error, not an order. Of a versioned table the
    current version is read.
    """
    path = _current(spark, path)
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    own = {PART, POS} & set(df.columns)
    if landed and len(own) == 2:
        return df
    if own:
        raise ValueError(f"column {min(own)!r} of {path} has a reserved name; rename it")
    if fmt == "parquet":
        part, pos = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    else:
        part, pos = _block_name(), F.monotonically_increasing_id()
    return df.select("*", part.alias(PART), pos.alias(POS))


def _current(spark: SparkSession, path: str | list[str]) -> str | list[str]:
    return current(spark, path) if isinstance(path, str) else [current(spark, p) for p in path]


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Deals the rows of a scan out to ``partitions`` tasks; with ``None`` they stay where they are.

    For inputs of few row groups or files on many cores. It shuffles the raw rows, so it is never
    done unless asked for.
    """
    return df if partitions is None else df.repartition(partitions, PART, POS)


def _block_name() -> Column:
    start = F.lpad(F.col("_metadata.file_block_start").cast("string"), 20, "0")
    return F.concat(F.col("_metadata.file_path"), F.lit("#"), start)


def read_or_empty(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    read: Callable[[SparkSession, str], DataFrame] = scan,
) -> DataFrame:
    """What ``read`` returns, or no rows of ``schema`` and a warning if the path does not exist."""
    if entry(spark, path) is not None or has_data(spark, path):
        return read(spark, path)
    log.warning("no data at %s, continuing without it", path)
    # Catalyst recognises this as empty and leaves it out of the plan.
    fields = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).where(F.lit(False)).select(*fields)


def read_json_records(
    spark: SparkSession, path: str, layout: str = "lines", landed: bool = False, raw: bool = False
) -> DataFrame:
    """JSON objects as ``part, pos, v``, where the variant ``v`` keeps the type of every value.

    ``raw`` adds each record's own text, in which its keys have their order; it goes with lines and documents.

    ``lines``     one object per line.
    ``indented``  files that each hold one array of objects written with an indent of two. The
                  lines between two records then serve as record separator, so a file is split
                  into blocks like any text file: a raw line break cannot occur inside a JSON
                  string, and nested objects are indented deeper.
    ``document``  files that each hold one array in any layout, split into blocks at its commas: a
                  scan of all blocks tells which of these part elements (``arrays``). It reads the
                  files three times; ``indented`` reads its own layout once or twice.

    Every element of an array is a record, also ``{}`` and ``null``. What is not valid JSON is an error,
    as is an array that is cut off or that something follows. ``landed`` as in ``scan``.
    """
    path, kept = _current(spark, path), [PART, POS, "v", "raw"] if raw else [PART, POS, "v"]
    if layout == "lines":
        return _read_lines(spark, path, landed).select(*kept)
    if layout == "document":
        return _read_elements(spark, path).select(*kept)
    if layout == "indented" and not raw:
        return _read_arrays(spark, path)
    raise ValueError(f"unknown layout {layout!r}" if not raw else f"the text of records is not kept with layout {layout!r}")


def _values(text: Column, strict: bool = True) -> Column:
    """The JSON values in a text that holds them with commas between; not so is an error, or null.

    Parsing stops after the first value, so the text is put in a list that something follows: if that
    is not reached, the text closed the list itself.
    """
    parse = F.parse_json if strict else F.try_parse_json
    whole = parse(F.concat(F.lit('{"values":['), text, F.lit('],"end":true}')))
    values = F.try_variant_get(whole, "$.values", "array<variant>")
    reached = F.coalesce(F.try_variant_get(whole, "$.end", "boolean"), F.lit(False))
    if not strict:
        return F.when(reached, values)
    return F.when(reached, values).otherwise(
        F.raise_error(F.lit("text after the end of a JSON value")).cast("array<variant>")
    )


def _read_lines(spark: SparkSession, path: str, landed: bool) -> DataFrame:
    line = F.col("value")
    values = _values(line)
    alone = F.when(F.size("_values") == 1, F.get("_values", F.lit(0))).otherwise(
        F.raise_error(F.lit("a line holds more than one JSON value")).cast("variant")
    )
    df = (
        spark.read.text(path)
        .select(_block_name().alias("_block"), F.monotonically_increasing_id().alias("_row"), "value")
        .where(F.trim(F.translate(line, "\t\r", "  ")) != "")
        .select("_block", "_row", "value", values.alias("_values"))
        .select("_block", "_row", F.col("value").alias("raw"), alone.alias("v"))
    )
    if not landed:
        return df.select(F.col("_block").alias(PART), F.col("_row").alias(POS), "v", "raw")
    part = F.try_variant_get("v", f"$.{PART}", "string")
    pos = F.try_variant_get("v", f"$.{POS}", "bigint")
    both = part.isNotNull() & pos.isNotNull()
    return df.select(
        F.when(both, part).otherwise(F.col("_block")).alias(PART),
        F.when(both, pos).otherwise(F.col("_row")).alias(POS),
        "v",
        "raw",
    )


def _read_elements(spark: SparkSession, path: str) -> DataFrame:
    part = F.concat("file", F.lit("#"), F.lpad(F.col("block").cast("string"), 20, "0"))
    alone = F.when(F.size("_values") == 1, F.get("_values", F.lit(0))).otherwise(
        F.raise_error(F.lit("an element is missing between two commas")).cast("variant")
    )
    elements = read_elements(spark, path).select(part.alias(PART), F.col("pos").alias(POS), "raw", _values(F.col("raw")).alias("_values"))
    return elements.select(PART, POS, alone.alias("v"), "raw")


def _read_arrays(spark: SparkSession, path: str) -> DataFrame:
    """Pieces between separator lines, each parsed as an array of the elements that it holds.

    The separator takes one element's closing and the next one's opening brace away, which the piece
    gets back. A file's first piece begins with the array's bracket; a piece is its last if it is
    whole with its final bracket taken for the array's, which a nested list's is not.
    """
    piece = F.btrim(F.col("value"), F.lit(" \t\r\n"))
    first = piece.startswith("[")
    inner = F.when(first, F.substr(piece, F.lit(2))).otherwise(F.concat(F.lit("{"), piece))
    closed = F.when(piece.endswith("]"), _values(F.left(inner, F.length(inner) - 1), strict=False))
    pieces = (
        spark.read.option("lineSep", ARRAY_SEPARATOR)
        .text(path)
        .where(piece != "")
        .select(_block_name().alias(PART), F.col("_metadata.file_path").alias("_file"), first.alias("_first"), inner.alias("_inner"), closed.alias("_closed"))
    )
    # Brackets are counted before anything is returned: a cut-off file has pieces that are whole.
    ends = pieces.groupBy("_file").agg(
        F.count_if("_first").alias("begun"), F.count_if(F.col("_closed").isNotNull()).alias("ended")
    )
    broken = ends.where("begun <> 1 OR ended <> 1").head()
    if broken:
        raise ValueError(f"{broken._file} does not hold exactly one JSON array")
    elements = F.coalesce(F.col("_closed"), _values(F.concat(F.col("_inner"), F.lit("}"))))
    return pieces.select(PART, F.explode(elements).alias("v")).select(
        PART, F.monotonically_increasing_id().alias(POS), "v"
    )


def text_fields(records: DataFrame, names: Sequence[str]) -> DataFrame:
    """Top-level fields of variant records as text; a missing field, null, number, boolean, list
    or object counts as ``''`` and is not converted."""
    kept = [c for c in records.columns if c != "v"]
    fields = [
        as_text(F.try_variant_get("v", f"$['{name}']", "variant"), T.VariantType()).alias(name)
        for name in names
    ]
    return records.select(*kept, *fields)


def land(df: DataFrame) -> DataFrame:
    """The rows as a parquet table in the shared folder.

    Worthwhile for rows from JSON that are read more than once: parsing happens once, and the row
    numbers assigned while reading become stored values that no later pass can see differently.
    """
    spark = df.sparkSession
    folder = new_folder(spark, "landed")
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def delete_landed(df: DataFrame) -> None:
    """Deletes the table that ``land`` wrote for these rows; they cannot be read any more."""
    for folder in {path.rpartition("/")[0] for path in df.inputFiles()}:
        delete_folder(df.sparkSession, folder)


def with_row_index(df: DataFrame, name: str, within: tuple[str, ...] = ()) -> DataFrame:
    """Adds each row's place in stored order, counted from 0 (per ``within`` group if given).

    Rows of a part are numbered consecutively by the scan, so only the number of rows before each part is
    missing. That is one small row per file or block, which is stored and then broadcast to the rows: all at
    once, or with more than ``BROADCAST_PARTS`` one range of parts after the other, each joined with the rows
    of its own parts only (a filter that leaves out other files). So rows stay where they are, whatever the
    number of parts. Use on a parquet scan or landed rows as they were stored: the rows are read
    twice, so ``pos`` has to be the same each time, and a filter in between would leave gaps.
    """
    keys = [*within, PART]
    before = Window.partitionBy(*within).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    parts = land(
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"), F.min(POS).alias("_first"))
        .select(*keys, (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    )
    frames = []
    for low, high in _ranges(parts):
        inside = F.lit(True)
        if low is not None:
            inside = inside & (F.col(PART) > low)
        if high is not None:
            inside = inside & (F.col(PART) <= high)
        frames.append(df.where(inside).join(F.broadcast(parts.where(inside)), keys))
    return reduce(DataFrame.unionByName, frames).withColumn(name, F.col(POS) + F.col("_shift")).drop("_shift")


def _ranges(parts: DataFrame) -> list[tuple[str | None, str | None]]:
    """Bounds (after, up to) of stretches of parts that are small enough to broadcast."""
    if parts.count() <= BROADCAST_PARTS:
        return [(None, None)]
    number = F.row_number().over(Window.orderBy(PART))
    ends = parts.select(PART).withColumn("_n", number).where(F.col("_n") % BROADCAST_PARTS == 0)
    bounds = [None, *sorted({r[PART] for r in ends.collect()}), None]
    return list(zip(bounds, bounds[1:]))


def first_file(rows: DataFrame) -> str | None:
    """The first file, by path, that holds any of the rows of a scan, or none.

    Files are opened in the order of the listing, at first one, then four times as many if those were empty, and of
    parquet only the footers are read.
    """
    # A listing writes an empty host out, the metadata column does not.
    files = sorted(re.sub(r"^(\w+):///", r"\1:/", file) for file in rows.inputFiles())
    path, opened = F.col("_metadata.file_path"), 1
    while files:
        some, files = files[:opened], files[opened:]
        found = rows.where(path.between(some[0], some[-1])).select(path.alias("path")).groupBy("path").agg(F.count(F.lit(1)))
        held = [r.path for r in found.collect()]
        if held:
            return min(held)
        opened *= 4
    return None


def first_record(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """The first row of a dataset, or none from one without rows: the same as ``first_row(scan(...))``.

    The file it stands in is chosen first (``first_file``), and the plan reads no other. Text formats
    should be given a ``schema``, as inferring one reads everything.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.load(_current(spark, path))
    file = first_file(rows)
    if file is None:
        return rows.limit(0)
    rows = rows.where(F.col("_metadata.file_path") == file)
    if fmt == "parquet":
        return rows.where(F.col("_metadata.row_index") == 0)
    start, place = F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    return rows.select("*", start.alias(PART), place.alias(POS)).orderBy(PART, POS).limit(1).drop(PART, POS)


def load_named_splits(
    spark: SparkSession,
    folder: str,
    fmt: str = "parquet",
    names: dict[str, str] | None = None,
) -> DataFrame:
    """Splits written by ``write_splits``, under the names a trainer expects.

    Only the folders of the wanted splits are listed and read; one without rows is simply empty.
    """
    names = names or {"train": "train", "val": "validation"}
    df = spark.read.schema(SPLIT_SCHEMA).format(fmt).load(current(spark, folder)).where(F.col("split").isin(*names))
    renamed = [F.when(F.col("split") == old, F.lit(new)) for old, new in names.items()]
    return df.withColumn("split", F.coalesce(*renamed))


def load_split_files(
    spark: SparkSession, files: dict[str, str], layout: str = "indented"
) -> DataFrame:
    """Splits from JSON files of another tool, one path per split name, in file order."""
    frames = []
    for name, path in files.items():
        records = read_json_records(spark, path, layout)
        rows = with_row_index(land(text_fields(records, ["instruction", "response"])), "split_row")
        rows = rows.withColumn("split", F.lit(name))
        frames.append(rows.select("split", "split_row", "instruction", "response"))
    return reduce(DataFrame.unionByName, frames)
