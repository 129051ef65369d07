"""A seeded global order, exact splits and caps, without a global sort."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

# Columns that give the order of input rows: source, file or block, place within it.
ORDER = ("src_rank", "part", "pos")

# The digest's first two bytes name one of this many buckets, all of about the same size.
BUCKETS = 65536
# A bucket with more keys than wanted is cut by up to so many further bits of the digest.
FURTHER_BITS = 5
BUCKET_KEYS = 100_000


def seeded_order(
    df: DataFrame,
    key: str = "instruction",
    order_cols: Sequence[str] = ORDER,
    seed: int = 42,
    partitions: int | None = None,
    bucket_keys: int = BUCKET_KEYS,
) -> DataFrame:
    """First copy of each key, with ``split_pos`` (its place, from 0) and ``n_unique``.

    The order is that of SHA-256 over seed and key. It depends on nothing else, so any layout of
    the same rows gives the same order, and equal keys are recognised by equal digests.

    1. A pass over the digests counts the copies of each key. Three small tables come out of it: into how
       many parts each bucket is cut, the number of keys before each part (together at most ``BUCKETS <<
       FURTHER_BITS`` rows), and the keys with more copies than an average bucket has rows (fewer than
       ``BUCKETS``, as the copies of all keys add up to the number of rows). All are broadcast.
    2. In the pass over the rows, later copies of those hot keys are dropped before the shuffle.
       The one shuffle of whole rows brings each stretch of buckets to one task, in digest order;
       there the remaining copies are dropped and the rows of each part are numbered.

    ``partitions`` defaults to ``spark.sql.shuffle.partitions``: set that to suit the data. Rows are numbered
    in parts of about ``bucket_keys`` at the most (more only beyond ``BUCKETS << FURTHER_BITS`` parts); the
    order does not depend on it.
    """
    spark = df.sparkSession
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = min(partitions, BUCKETS)

    # Neither is ever null; saying so keeps Catalyst from adding null filters that would evaluate
    # the whole cleaning expression once more.
    digest = F.coalesce(
        F.unhex(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key)), 256)), F.lit(bytearray(32))
    )
    bucket = F.coalesce(
        F.conv(F.hex(F.substring("_digest", 1, 2)), 16, 10).cast("int"), F.lit(0)
    )
    # The byte after the bucket's; of it the leading bits that cut the bucket into its parts.
    next_byte = F.coalesce(F.conv(F.hex(F.substring("_digest", 3, 1)), 16, 10).cast("int"), F.lit(0))
    part = F.floor(next_byte * F.coalesce("_parts", F.lit(1)) / 256).cast("int")
    place = F.struct(*order_cols)
    keyed = df.withColumn("_digest", digest).withColumn("_bucket", bucket)

    copies = keyed.groupBy("_bucket", "_digest").agg(
        F.count(F.lit(1)).alias("_copies"), F.min(place).alias("_first")
    )
    # True for every row. It makes each use of `copies` need all of its columns, so that Spark
    # sees the same shuffle in all of them and runs it once.
    counted = (F.col("_copies") > 0) & F.col("_first").isNotNull()
    in_order = Window.orderBy("_bucket", "_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    # Counted by the finest parts first: the parts of a bucket are runs of them.
    finest = 1 << FURTHER_BITS
    fine = copies.groupBy("_bucket", F.floor(next_byte * finest / 256).cast("int").alias("_fine")).agg(
        F.count_if(counted).alias("_keys"), F.sum(F.when(counted, F.col("_copies"))).alias("_rows")
    )
    whole = fine.groupBy("_bucket").agg(F.sum("_keys").alias("_all"), F.sum("_rows").alias("_rows"))
    wanted = F.ceil(F.log2(F.greatest(F.col("_all") / bucket_keys, F.lit(1.0))))
    parts = F.pow(F.lit(2.0), F.least(wanted, F.lit(FURTHER_BITS))).cast("int")
    whole = whole.withColumn("_parts", parts)
    fine = fine.join(F.broadcast(whole.select("_bucket", "_parts")), "_bucket").withColumn(
        "_part", F.floor(F.col("_fine") * F.col("_parts") / finest).cast("int")
    )
    offsets = (
        fine.groupBy("_bucket", "_part")
        .agg(F.sum("_keys").alias("_keys"))
        .select(
            "_bucket",
            "_part",
            F.coalesce(F.sum("_keys").over(in_order), F.lit(0)).alias("_before"),
            F.sum("_keys").over(everything).alias("n_unique"),
        )
    )
    cut = whole.where("_parts > 1").select("_bucket", "_parts")
    n_rows = whole.select("_bucket", F.sum("_rows").over(everything).alias("_n_rows"))
    hot = (
        copies.where("_copies > 1")
        .join(F.broadcast(n_rows), "_bucket")
        .where(F.col("_copies") * BUCKETS > F.col("_n_rows"))
        .select("_digest", "_first")
    )

    target = F.shiftright(F.col("_bucket").cast("bigint") * partitions, 16).cast("int")
    placed = (
        keyed.join(F.broadcast(hot), "_digest", "left")
        .where(F.col("_first").isNull() | F.col("_first").eqNullSafe(place))
        .drop("_first")
        .join(F.broadcast(cut), "_bucket", "left")
        .withColumn("_part", part)
        .drop("_parts")
        .withColumn("_target", target)
        .repartitionById(partitions, "_target")
    )
    same_key = Window.partitionBy("_target", "_bucket", "_part", "_digest").orderBy(*order_cols)
    in_part = Window.partitionBy("_target", "_bucket", "_part").orderBy("_digest")
    return (
        placed.withColumn("_copy", F.row_number().over(same_key))
        .where("_copy = 1")
        .withColumn("_row", F.row_number().over(in_part))
        .join(F.broadcast(offsets), ["_bucket", "_part"])
        .withColumn("split_pos", F.col("_before") + F.col("_row") - 1)
        .select(*df.columns, "split_pos", "n_unique")
    )


def assign_split(df: DataFrame, train: float = 0.8, val: float = 0.1) -> DataFrame:
    """Exact contiguous ``split``s of ``seeded_order``'s rows, and ``split_row`` within each.

    Sizes are rounded down; what remains goes to test.
    """
    n, pos = F.col("n_unique"), F.col("split_pos")
    train_end = F.floor(F.lit(float(train)) * n)
    val_end = train_end + F.floor(F.lit(float(val)) * n)
    return df.select(
        *[c for c in df.columns if c != "n_unique"],
        F.when(pos < train_end, "train").when(pos < val_end, "val").otherwise("test").alias("split"),
        (
            F.when(pos < train_end, pos)
            .when(pos < val_end, pos - train_end)
            .otherwise(pos - val_end)
        ).alias("split_row"),
    )


def cap_per_split(df: DataFrame, caps: Mapping[str, int | None]) -> DataFrame:
    """The first rows of each split named in ``caps``; ``None`` keeps all, below 1 keeps none.

    A plain predicate: on written splits it prunes folders, and files and row groups through the
    statistics of ``split_row``.
    """
    wanted = F.lit(False)
    for name, cap in caps.items():
        of_split = F.col("split") == name
        if cap is not None:
            of_split = of_split & (F.col("split_row") < max(cap, 0))
        wanted = wanted | of_split
    return df.where(wanted)


def first_row(df: DataFrame, order_cols: Sequence[str] = ("part", "pos")) -> DataFrame:
    """The row that comes first, or none from an empty table."""
    return df.orderBy(*order_cols).limit(1)
