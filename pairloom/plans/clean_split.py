"""Stage 2: from raw tables to disjoint train, validation and test sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from pairloom.operators.order import ORDER, assign_split, seeded_order
from pairloom.operators.pairs import clean_pairs, union_ordered
from pairloom.sources.readers import (
    delete_landed,
    land,
    read_json_records,
    read_or_empty,
    scan,
    spread,
    text_fields,
)
from pairloom.sources.writers import write_splits

RAW_SCHEMA = T.StructType(
    [
        T.StructField("part", T.StringType()),
        T.StructField("pos", T.LongType()),
        T.StructField("instruction", T.StringType()),
        T.StructField("response", T.StringType()),
    ]
)


def clean_and_split(
    sources: Sequence[DataFrame],
    seed: int = 42,
    fractions: tuple[float, float] = (0.8, 0.1),
    partitions: int | None = None,
) -> DataFrame:
    """``instruction, response, split, split_pos, split_row`` of the unique clean pairs.

    Where two rows share an instruction, the earlier source wins, then the earlier row.
    """
    pairs = union_ordered([clean_pairs(source) for source in sources])
    ordered = seeded_order(pairs, "instruction", ORDER, seed, partitions)
    return assign_split(ordered, *fractions).drop(*ORDER)


def clean_and_split_folder(
    spark: SparkSession,
    raw_folder: str,
    names: Sequence[str],
    out_folder: str,
    layout: str = "parquet",
    out_fmt: str = "parquet",
    seed: int = 42,
    fractions: tuple[float, float] = (0.8, 0.1),
    partitions: int | None = None,
    input_partitions: int | None = None,
    versioned: bool = False,
) -> None:
    """``clean_and_split`` from raw tables or files to split folders, replacing what is there.

    ``names`` are in order of precedence; a source that is not there counts as empty. ``layout``
    is ``parquet`` or one of ``read_json_records``; either way a value that is not text is empty.
    Raw tables that ``collect`` has written carry their order. ``partitions`` sizes the shuffle of whole
    rows, ``input_partitions`` deals small inputs out to more tasks. Landed copies are deleted at the end.
    ``versioned`` as in ``write_splits``; raw tables of either kind are read.
    """
    copies = []

    def read(spark: SparkSession, path: str) -> DataFrame:
        if layout == "parquet":
            return scan(spark, path, landed=True)
        records = read_json_records(spark, path, layout, landed=True)
        rows = land(text_fields(records, ["instruction", "response"]))
        copies.append(rows)
        return rows

    sources = [
        read_or_empty(spark, f"{raw_folder}/{name}", RAW_SCHEMA, read) for name in names
    ]
    try:
        dealt = [spread(s, input_partitions) for s in sources]
        write_splits(clean_and_split(dealt, seed, fractions, partitions), out_folder, out_fmt, versioned)
    finally:
        for rows in copies:
            delete_landed(rows)
