from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from pairloom.operators import (
    assign_split,
    cap_per_split,
    clean_pairs,
    count_by_split,
    dedup_keep_first,
    first_row,
    pair_counts,
    seeded_order,
)
from pairloom.plans import clean_and_split, prepare_training_set

SCHEMA = "src_rank int, part string, pos bigint, instruction string, response string"


def rows_of(keys):
    return [(i % 2, f"f{i % 3}", i, key, f"r{i}") for i, key in enumerate(keys)]


def brute_force(rows, seed=42):
    first = {}
    for row in sorted(rows, key=lambda r: r[:3]):
        first.setdefault(row[3], row)
    by_digest = sorted(
        first.values(), key=lambda r: hashlib.sha256(f"{seed}:{r[3]}".encode()).digest()
    )
    return [(r[3], r[4], i) for i, r in enumerate(by_digest)]


def ordered_rows(df, **options):
    rows = seeded_order(df, **options).select("instruction", "response", "split_pos").collect()
    return sorted(((r.instruction, r.response, r.split_pos) for r in rows), key=lambda r: r[2])


@pytest.fixture(scope="module")
def skewed_rows():
    rng = random.Random(7)
    keys = ["hot"] * 700 + ["warm"] * 300 + [f"k{rng.randrange(400)}" for _ in range(1000)]
    rng.shuffle(keys)
    return rows_of(keys)


@pytest.mark.parametrize("layout", [1, 7, 64])
@pytest.mark.parametrize("partitions", [1, 5, None])
def test_order_equals_brute_force_in_any_layout(spark, skewed_rows, layout, partitions):
    df = spark.createDataFrame(skewed_rows, SCHEMA).repartition(layout)
    assert ordered_rows(df, partitions=partitions) == brute_force(skewed_rows)


@pytest.mark.parametrize("bucket_keys", [0.01, 0.3, 1, 3])
def test_buckets_cut_further_keep_the_order(spark, skewed_rows, bucket_keys):
    df = spark.createDataFrame(skewed_rows, SCHEMA).repartition(5)
    assert ordered_rows(df, bucket_keys=bucket_keys, partitions=3) == brute_force(skewed_rows)


def test_parts_of_a_bucket_are_small(spark):
    """Rows of one bucket only: as many keys as a crowded one has, made by choosing keys by their digest."""
    keys, n = [], 0
    while len(keys) < 40:
        n += 1
        if hashlib.sha256(f"42:k{n}".encode()).digest()[0] == 7 and hashlib.sha256(f"42:k{n}".encode()).digest()[1] < 4:
            keys.append(f"k{n}")
    rows = rows_of(keys * 3)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for bucket_keys in (1, 2, 4, 1000):
        assert ordered_rows(df, bucket_keys=bucket_keys) == brute_force(rows)


def test_order_depends_on_the_seed(spark, skewed_rows):
    df = spark.createDataFrame(skewed_rows, SCHEMA)
    assert ordered_rows(df, seed=7) == brute_force(skewed_rows, seed=7) != brute_force(skewed_rows)


def test_order_is_that_of_separate_steps(spark, skewed_rows):
    df = spark.createDataFrame(skewed_rows, SCHEMA)
    assert ordered_rows(df) == ordered_rows(dedup_keep_first(df))


def test_dedup_equals_brute_force(spark, skewed_rows):
    df = spark.createDataFrame(skewed_rows, SCHEMA).repartition(16)
    got = {(r.instruction, r.response) for r in dedup_keep_first(df).collect()}
    assert got == {r[:2] for r in brute_force(skewed_rows)}


def final_plan(df):
    df.collect()
    mode = df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return text[: text.index("== Initial Plan")]


def test_hot_copies_stay_out_of_the_row_shuffle(spark):
    # One key has a third of all rows; the rest are spread over many keys.
    n = 30_000
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id")))
    df = spark.range(n, numPartitions=8).select(
        F.lit(0).alias("src_rank"),
        F.lit("f").alias("part"),
        F.col("id").alias("pos"),
        key.alias("instruction"),
        F.lit("r").alias("response"),
    )
    plan = final_plan(seeded_order(df))
    row_shuffle = re.search(r"Sort.*\n.*ShuffleQueryStage.*rowCount=([\d.E+]+)", plan)
    assert float(row_shuffle.group(1)) == pytest.approx(n * 2 // 3 + 1, rel=0.01)


def test_plan_of_the_order(spark, tmp_path):
    rows = spark.createDataFrame(rows_of([f"k{i % 500}" for i in range(2000)]), SCHEMA)
    rows.write.parquet(str(tmp_path / "t"))
    plan = final_plan(clean_and_split([spark.read.parquet(str(tmp_path / "t"))]))
    # One scan for the digests (shared by everything derived from them) and one for the rows.
    assert plan.count("Scan parquet") == 2
    assert "Exchange" in plan and not re.search("SortMergeJoin|Cartesian|Python", plan)


def test_single_partition_steps_hold_one_row_per_bucket(spark):
    df = spark.range(5000).select(
        F.lit(0).alias("src_rank"), F.lit("").alias("part"), F.col("id").alias("pos"),
        F.col("id").cast("string").alias("instruction"), F.lit("r").alias("response"),
    )
    plan = seeded_order(df)._jdf.queryExecution().executedPlan().toString()
    for block in re.findall(r"Exchange SinglePartition.*\n(.*)\n", plan):
        assert "HashAggregate(keys=[_bucket" in block


@pytest.mark.parametrize(
    "n,sizes",
    [(0, (0, 0, 0)), (1, (0, 0, 1)), (5, (4, 0, 1)), (9, (7, 0, 2)), (10, (8, 1, 1)),
     (11, (8, 1, 2)), (945, (756, 94, 95))],
)
def test_split_sizes(spark, n, sizes):
    df = spark.createDataFrame(rows_of([f"k{i}" for i in range(n)]), SCHEMA)
    counts = {r.split: r.n_rows for r in count_by_split(assign_split(seeded_order(df))).collect()}
    assert (counts["train"], counts["val"], counts["test"]) == sizes


def test_split_boundaries_for_small_tables(spark):
    positions = [(n, pos) for n in range(31) for pos in range(n)]
    df = spark.createDataFrame(positions, "n_unique bigint, split_pos bigint")
    df = df.withColumn("n", F.col("n_unique"))
    got = {(r.n, r.split_pos): (r.split, r.split_row) for r in assign_split(df).collect()}
    for n in range(31):
        cut = int(n * 0.8), int(n * 0.8) + int(n * 0.1)
        parts = {"train": range(0, cut[0]), "val": range(*cut), "test": range(cut[1], n)}
        for name, places in parts.items():
            assert [got[n, p] for p in places] == [(name, i) for i in range(len(places))]


@pytest.mark.parametrize("cap,left", [(None, 10), (3, 3), (50, 10), (0, 0), (-1, 0)])
def test_caps(spark, cap, left):
    df = spark.createDataFrame(
        [(s, i) for s in ("train", "validation", "test") for i in range(10)],
        "split string, split_row bigint",
    )
    got = cap_per_split(df, {"train": cap, "validation": 4}).collect()
    assert sorted(r.split_row for r in got if r.split == "train") == list(range(left))
    assert len([r for r in got if r.split == "validation"]) == 4
    assert not [r for r in got if r.split == "test"]


@pytest.mark.parametrize(
    "options,sizes",
    [
        ({}, (100, 30)),
        ({"max_train": 70, "max_validation": 5}, (70, 5)),
        ({"smoke": True}, (50, 10)),
        ({"smoke": True, "max_train": 20}, (20, 10)),
        ({"smoke": True, "max_train": 80, "max_validation": 0}, (50, 0)),
    ],
)
def test_prepare_sizes(spark, options, sizes):
    rows = [(s, i, "q", "a") for s, n in (("train", 100), ("validation", 30)) for i in range(n)]
    schema = "split string, split_row bigint, instruction string, response string"
    df = spark.createDataFrame(rows, schema)
    counts = count_by_split(prepare_training_set(df, **options), ("train", "validation")).collect()
    assert {r.split: r.n_rows for r in counts} == dict(zip(("train", "validation"), sizes))


def test_no_instruction_in_two_splits(spark, skewed_rows):
    df = spark.createDataFrame(skewed_rows, SCHEMA).drop("src_rank")
    split = clean_and_split([df, df])
    assert split.groupBy("instruction").count().where("count > 1").count() == 0


def test_cleaning_comes_before_dedup(spark):
    rows = [("f", 0, "a  “b”", "first"), ("f", 1, " a \"b\"\t", "second"), ("f", 2, "A \"b\"", "third")]
    df = spark.createDataFrame(rows, "part string, pos bigint, instruction string, response string")
    got = {(r.instruction, r.response) for r in clean_and_split([df]).collect()}
    assert got == {('a "b"', "first"), ('A "b"', "third")}


def test_earlier_source_wins(spark):
    schema = "part string, pos bigint, instruction string, response string"
    late = spark.createDataFrame([("a", 0, "q", "from the second source")], schema)
    early = spark.createDataFrame([("z", 9, "q", "from the first source")], schema)
    assert clean_and_split([early, late]).first().response == "from the first source"


def test_pair_counts_of_nothing(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert tuple(pair_counts(df).first()) == (0, 0, 0)


def test_first_row_of_nothing(spark):
    assert first_row(spark.createDataFrame([], SCHEMA)).collect() == []


def test_clean_pairs_reads_only_what_it_needs(spark, tmp_path):
    df = spark.createDataFrame([("q", "a", "c", "i")], "instruction string, response string, category string, intent string")
    df.write.parquet(str(tmp_path / "t"))
    plan = clean_pairs(spark.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<instruction:string,response:string>" in plan


def test_copies_of_cold_keys_are_dropped(spark):
    """More rows than buckets, so that keys with a few copies are not hot; one key is."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 120_000))
    rows = spark.range(300_000, numPartitions=4).select(
        F.lit(0).alias("src_rank"), F.lit("p").alias("part"), F.col("id").alias("pos"), key.alias("instruction")
    )
    found = seeded_order(rows).agg(
        F.count("*"), F.countDistinct("instruction"), F.countDistinct("split_pos"), F.max("split_pos") + 1, F.sum("pos"), F.max("n_unique")
    ).first()
    n, total = rows.groupBy("instruction").agg(F.min("pos").alias("p")).agg(F.count("*"), F.sum("p")).first()
    assert tuple(found) == (n, n, n, n, total, n)
