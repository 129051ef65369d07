"""Helpers shared by the operators: stored intermediate tables, worker functions, bounded samples."""

from __future__ import annotations

import pickle
import sys
import zlib

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from pairloom.session import new_folder

# White space of the contracts: space and the five controls from tab to carriage return. These
# are also what ``bytes.split()`` splits at.
SPACES = " \t\n\x0b\x0c\r"


def ship(module_name: str) -> None:
    """Lets functions of a module travel to the executors whole, so that they need no package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship(__name__)


class Parcel:
    """An object to be broadcast. Workers get the object itself, with its class, so that they need no package;
    a broadcast's own pickling would only name the class's module."""

    def __init__(self, value: object) -> None:
        self.value = value

    def __reduce__(self) -> tuple:
        return pickle.loads, (cloudpickle.dumps(self.value),)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a parquet table in the shared folder.

    Cuts the lineage: a later stage that loses an executor reads the table again instead of
    computing everything before it.
    """
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names derived from ``names`` that the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        found.append(name)
    return found


def crc32_text(col: str) -> Column:
    """CRC-32 of a value written as text; null stays null."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


def crc32_of(value: object) -> int:
    return zlib.crc32(str(value).encode())


def held_out(col: str, modulus: int, remainder: int) -> Column:
    """True where the id's CRC-32 leaves that remainder; a null id is never held out."""
    return F.coalesce(F.pmod(crc32_text(col), F.lit(modulus)) == remainder, F.lit(False))


def row_hash(*cols: str) -> Column:
    """A number by which rows are drawn or dealt: it depends on the values only."""
    return F.xxhash64(*[F.col(c) for c in cols])


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds each row's place, from 0, in the order of the given columns over the whole table.

    Rows are dealt into sorted stretches, and a stretch begins after all rows of those before it; the
    table of stretches has one row per task. No task sees more than its stretch.
    """
    stretch, place, key, before, rows = fresh(df, "_stretch", "_place", "_key", "_before", "_rows")
    dealt = df.withColumn(key, F.struct(*order)).repartitionByRange(F.col(key))
    dealt = stored(dealt.withColumn(stretch, F.spark_partition_id()), "ranked")
    sizes = dealt.groupBy(stretch).agg(F.count(F.lit(1)).alias(rows))
    earlier = Window.orderBy(stretch).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(stretch, F.coalesce(F.sum(rows).over(earlier), F.lit(0)).alias(before))
    within = Window.partitionBy(stretch).orderBy(key)
    return (
        dealt.withColumn(place, F.row_number().over(within))
        .join(F.broadcast(starts), stretch)
        .select(*df.columns, (F.col(before) + F.col(place) - 1).alias(name))
    )
