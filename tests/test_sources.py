from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from pairloom.operators import cap_per_split, count_by_split, length_budget, map_rows
from pairloom.plans import Source, clean_and_split, clean_and_split_folder, collect
from pairloom.sources import (
    load_named_splits,
    load_split_files,
    materialise_if_absent,
    read_json_records,
    scan,
    split_file_report,
    text_fields,
    with_row_index,
    write_json_arrays,
    write_raw,
    write_splits,
)

RECORDS = [
    {"instruction": f"q{i} \n «é»", "response": "line\n  },\n  {\nnext", "n": i, "deep": {"a": [{"b": i}]}}
    for i in range(300)
]


@pytest.fixture
def small_blocks(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def numbers(df):
    rows = df.select("part", "pos", F.try_variant_get("v", "$.n", "int").alias("n")).collect()
    return [r.n for r in sorted(rows, key=lambda r: (r.part, r.pos))]


@pytest.mark.parametrize("end", ["", "\n"])
def test_indented_array_is_split_into_blocks(spark, tmp_path, small_blocks, end):
    path = tmp_path / "a.json"
    path.write_text(json.dumps(RECORDS, ensure_ascii=False, indent=2) + end, encoding="utf-8")
    df = read_json_records(spark, str(path), "indented")
    assert df.select("part").distinct().count() > 5
    assert numbers(df) == list(range(300))
    row = text_fields(df.where(F.try_variant_get("v", "$.n", "int") == 7), ["instruction", "response", "n", "deep"]).first()
    assert (row.instruction, row.response, row.n, row.deep) == (
        RECORDS[7]["instruction"], RECORDS[7]["response"], "", "",
    )


@pytest.mark.parametrize("n", [0, 1, 2])
@pytest.mark.parametrize("layout,indent", [("indented", 2), ("document", 2), ("document", None)])
def test_short_arrays(spark, tmp_path, n, layout, indent):
    path = tmp_path / "a.json"
    path.write_text(json.dumps(RECORDS[:n], indent=indent), encoding="utf-8")
    assert numbers(read_json_records(spark, str(path), layout)) == list(range(n))


def test_json_lines(spark, tmp_path, small_blocks):
    path = tmp_path / "a.jsonl"
    path.write_text("\n".join(map(json.dumps, RECORDS)), encoding="utf-8")
    assert numbers(read_json_records(spark, str(path), "lines")) == list(range(300))


@pytest.mark.parametrize("layout", ["indented", "lines", "document"])
def test_invalid_json_is_an_error(spark, tmp_path, layout):
    path = tmp_path / "a.json"
    path.write_text('[\n  {\n    "n": 1,\n    "m": \n  }\n]', encoding="utf-8")
    with pytest.raises(Exception):
        read_json_records(spark, str(path), layout).collect()


@pytest.mark.parametrize("layout", ["indented", "document"])
def test_arrays_of_anything_lose_nothing(spark, tmp_path, small_blocks, layout):
    """Random elements, also empty and null ones, in several layouts, against ``json.load``."""
    draw = random.Random(7)
    for case in range(12):
        kinds = [lambda: {}, lambda: None, lambda: {"n": 1, "l": [1, [2]]}, lambda: {"a": "x]\n  },\n  {\n", "l": []}, lambda: {"l": [{"x": "}"}]}]
        elements = [draw.choice(kinds)() for _ in range(draw.choice([1, 2, 7, 60]))]
        text = json.dumps(elements, indent=draw.choice([2, 2, 2, None, 4]))
        if case % 3 == 0:
            text = text.replace("\n", "\r\n")
        path = tmp_path / f"{case}.json"
        path.write_bytes((text + draw.choice(["", "\n", "\r\n "])).encode())
        rows = read_json_records(spark, str(path), layout).select("part", "pos", F.to_json("v").alias("j")).collect()
        got = [json.loads(r.j) if r.j else None for r in sorted(rows, key=lambda r: (r.part, r.pos))]
        assert got == json.loads(text), case


@pytest.mark.parametrize("keep", [0.3, 0.6, 0.99])
def test_cut_off_arrays_and_trailing_text_are_errors(spark, tmp_path, keep):
    text = json.dumps(RECORDS[:20], indent=2)
    cut = text[: int(len(text) * keep)]
    whole = text[: text.rindex("\n  },\n  {")]  # ends after a value
    for n, wrong in enumerate([cut, whole, whole + "\n  }", text + " xxx", text + text, "{}", ""]):
        path = tmp_path / f"{n}.json"
        path.write_text(wrong, encoding="utf-8")
        if wrong:
            with pytest.raises(Exception):
                read_json_records(spark, str(path), "indented").collect()


def test_two_values_on_a_line_are_an_error(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"a": 1}\n\n{"a": 2} {"a": 3}\n', encoding="utf-8")
    with pytest.raises(Exception):
        read_json_records(spark, str(path), "lines").collect()


def test_own_order_columns_are_no_order(spark, tmp_path):
    rows = [("q", "first", "z", 9), ("q", "second", "a", 1)]
    frame = spark.createDataFrame(rows, "instruction string, response string, part string, pos long").coalesce(1)
    frame.write.parquet(str(tmp_path / "p"))
    with pytest.raises(ValueError, match="reserved"):
        scan(spark, str(tmp_path / "p"))
    frame.write.json(str(tmp_path / "j"))
    records = text_fields(read_json_records(spark, str(tmp_path / "j")), ["instruction", "response"])
    assert [r.response for r in clean_and_split([records]).collect()] == ["first"]
    assert scan(spark, str(tmp_path / "p"), landed=True).where("pos = 9").count() == 1


def test_failing_rerun_keeps_the_last_table(spark, tmp_path):
    spark.range(10).select(F.col("id").cast("string").alias("instruction")).write.parquet(str(tmp_path / "in"))
    good = Source("s", str(tmp_path / "in"), lambda df: df.withColumn("response", F.lit("r")))
    broken = F.when(F.col("instruction") == "7", F.raise_error(F.lit("no"))).otherwise("r")
    bad = Source("s", str(tmp_path / "in"), lambda df: df.withColumn("response", broken.cast("string")))
    raw = str(tmp_path / "raw")
    assert [r.status for r in collect(spark, [good], raw).collect()] == ["saved"]
    assert [r.status for r in collect(spark, [bad], raw).collect()] == ["failed"]
    assert spark.read.parquet(f"{raw}/s").count() == 10
    assert [p.name for p in (tmp_path / "raw").iterdir()] == ["s"]
    (tmp_path / "raw" / "empty").mkdir()
    clean_and_split_folder(spark, raw, ["s", "empty"], str(tmp_path / "out"), fractions=(0.5, 0.2), partitions=3)
    assert {r.split: r["count"] for r in spark.read.parquet(str(tmp_path / "out")).groupBy("split").count().collect()} == {"train": 5, "val": 2, "test": 3}


def test_written_arrays_are_plain_json(spark, tmp_path):
    df = spark.range(1000, numPartitions=3).select(
        F.col("id").alias("n"), F.concat(F.lit("é\n \"“"), F.col("id")).alias("instruction"),
        F.lit(None).cast("string").alias("response"),
    )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    write_json_arrays(df, str(tmp_path / "out"))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    files = sorted((tmp_path / "out").glob("part-*"))
    records = [r for f in files for r in json.loads(f.read_text(encoding="utf-8"))]
    assert len(files) == 3 and sorted(r["n"] for r in records) == list(range(1000))
    assert {"n", "instruction", "response"} == set(records[0])
    assert sorted(numbers(read_json_records(spark, str(tmp_path / "out"), "indented"))) == list(range(1000))


def test_parquet_order_and_row_index(spark, tmp_path):
    spark.range(1000).repartitionByRange(7, "id").sortWithinPartitions("id").write.parquet(str(tmp_path / "t"))
    df = with_row_index(scan(spark, str(tmp_path / "t")), "row")
    assert df.where("row <> id").count() == 0 and df.count() == 1000


def test_reserved_column_name(spark, tmp_path):
    spark.range(3).withColumnRenamed("id", "pos").write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError, match="reserved"):
        scan(spark, str(tmp_path / "t"))


def test_foreign_split_files_keep_their_order(spark, tmp_path, small_blocks):
    files = {}
    for name, n in (("train", 120), ("validation", 30)):
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps(RECORDS[:n], indent=2, ensure_ascii=False), encoding="utf-8")
        files[name] = str(path)
    capped = cap_per_split(load_split_files(spark, files), {"train": 100, "validation": None}).collect()
    for name, n in (("train", 100), ("validation", 30)):
        rows = sorted((r.split_row, r.instruction) for r in capped if r.split == name)
        assert rows == [(i, RECORDS[i]["instruction"]) for i in range(n)]


def raw(n):
    return [{"instruction": f"q{i % 40}", "response": f"a{i}"} for i in range(n)]


@pytest.mark.parametrize("layout", ["indented", "document"])
def test_stage_two_from_existing_files(spark, tmp_path, layout):
    (tmp_path / "one.json").write_text(json.dumps(raw(50), indent=2))
    (tmp_path / "two.json").write_text(
        json.dumps([{"instruction": "q1", "response": "late"}, {"instruction": 5, "response": "x"},
                    {"response": "y"}, {"instruction": "new", "response": "z"}], indent=2)
    )
    out = str(tmp_path / "out")
    clean_and_split_folder(spark, str(tmp_path), ["one.json", "two.json", "three.json"], out, layout)
    rows = spark.read.parquet(out).collect()
    assert {(r.instruction, r.response) for r in rows} == {(f"q{i}", f"a{i}") for i in range(40)} | {("new", "z")}
    assert sorted(r.split_pos for r in rows) == list(range(41))


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_no_source_at_all_gives_empty_splits(spark, tmp_path, fmt):
    out = str(tmp_path / "out")
    clean_and_split_folder(spark, str(tmp_path), ["one", "two"], out, out_fmt=fmt)
    assert load_named_splits(spark, out, fmt).count() == 0
    report = split_file_report(spark, out).collect()
    assert len(report) == 3


def test_collect_isolates_failures_and_counts(spark, tmp_path):
    spark.createDataFrame([("a", "b")] * 5, "instruction string, response string").write.parquet(str(tmp_path / "good"))

    def broken(df):
        raise KeyError("no such thing")

    status = collect(
        spark,
        [
            Source("bad", str(tmp_path / "good"), broken),
            Source("runtime", str(tmp_path / "good"), lambda df: df.withColumn("x", F.raise_error(F.lit("boom")))),
            Source("good", str(tmp_path / "good"), lambda df: df),
            Source("empty", str(tmp_path / "good"), lambda df: df.where("instruction = 'none'")),
        ],
        str(tmp_path / "raw"),
    )
    assert [tuple(r) for r in status.collect()] == [
        ("bad", "failed", 0), ("runtime", "failed", 0), ("good", "saved", 5), ("empty", "saved", 0),
    ]


@pytest.mark.parametrize("fmt,layout", [("parquet", "parquet"), ("json", "lines")])
def test_collect_then_clean_keeps_the_first_of_the_original_order(spark, tmp_path, fmt, layout):
    rows = [(f"q{i % 30}", f"a{i}") for i in range(3000)]
    spark.createDataFrame(rows, "question string, answer string").coalesce(1).write.parquet(str(tmp_path / "src"))
    source = Source("one", str(tmp_path / "src"), lambda df: df.selectExpr("question as instruction", "answer as response", "part", "pos").repartition(5))
    collect(spark, [source], str(tmp_path / "raw"), fmt)
    clean_and_split_folder(spark, str(tmp_path / "raw"), ["one"], str(tmp_path / "out"), layout)
    got = {(r.instruction, r.response) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(f"q{i}", f"a{i}") for i in range(30)}


def test_raw_json_is_unescaped_and_keeps_nulls(spark, tmp_path):
    df = spark.createDataFrame([("é“", None)], "instruction string, response string").coalesce(1)
    assert write_raw(df, str(tmp_path / "raw")) == 1
    line = next((tmp_path / "raw").glob("part-*")).read_text(encoding="utf-8").strip()
    assert line == '{"instruction":"é“","response":null}'


def splits_of(spark, n):
    df = spark.createDataFrame([("f", i, f"q{i}", "a") for i in range(n)], "part string, pos bigint, instruction string, response string")
    return clean_and_split([df])


def test_written_splits_overwrite_and_report(spark, tmp_path):
    out = str(tmp_path / "out")
    write_splits(splits_of(spark, 30), out)
    write_splits(splits_of(spark, 4), out)
    assert spark.read.parquet(out).count() == 4
    report = {r.split: r for r in split_file_report(spark, out).collect()}
    assert report["train"].present and not report["val"].present and report["test"].present
    assert report["val"].n_files == 0 and report["val"].size_mb is None
    counts = {r.split: r.n_rows for r in count_by_split(spark.read.parquet(out)).collect()}
    assert counts == {"train": 3, "val": 0, "test": 1}


def test_capped_read_is_pruned(spark, tmp_path):
    out = str(tmp_path / "out")
    write_splits(splits_of(spark, 200), out)
    capped = cap_per_split(load_named_splits(spark, out), {"train": 10, "validation": 5})
    plan = capped._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(LessThan(split_row,10),LessThan(split_row,5))]" in plan
    assert "PartitionFilters: [split" in plan
    assert capped.count() == 15
    # Each file holds one stretch of the order, so statistics tell which files matter.
    files = spark.read.parquet(out).groupBy("split", F.col("_metadata.file_path")).agg(
        F.min("split_row").alias("lo"), F.max("split_row").alias("hi"), F.count("*").alias("n")
    )
    assert files.where("hi - lo + 1 <> n").count() == 0
    in_order = F.col("split_row") - F.col("_metadata.row_index")
    starts = spark.read.parquet(out).groupBy(F.col("_metadata.file_path")).agg(
        F.countDistinct(in_order).alias("n")
    )
    assert starts.where("n <> 1").count() == 0


def test_writing_leaves_the_session_as_it_was(spark, tmp_path):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    write_splits(splits_of(spark, 5), str(tmp_path / "out"))
    assert spark.conf.get(name) == before


def test_materialise_only_once(spark, tmp_path):
    out = str(tmp_path / "out")
    calls = []

    def build():
        calls.append(1)
        return splits_of(spark, 10)

    for _ in range(2):
        materialise_if_absent(spark, out, build)
    assert len(calls) == 1 and spark.read.parquet(out).count() == 10


def test_length_budget(spark):
    texts = ["", None, "a", " a \n b ", "w " * 512, "w " * 513, "w " * 5000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = [r for r in length_budget(df).orderBy("i").collect()]
    assert [r.n_tokens for r in got] == [0, 0, 1, 2, 512, 513, 5000]
    assert [r.over_budget for r in got] == [False] * 5 + [True] * 2
    assert [r.budget_text for r in got[:4]] == ["", "", "a", "a b"]
    assert all(r.budget_text == " ".join(["w"] * 512) for r in got[4:])


def test_length_budget_with_a_tokenizer(spark):
    def load():
        return lambda texts, limit: [(len(t), t[:limit]) for t in texts]

    df = spark.createDataFrame([("abcdef",), (None,)], "text string")
    got = length_budget(df, max_tokens=4, tokenizer=load).collect()
    assert {(r.text, r.n_tokens, r.over_budget, r.budget_text) for r in got} == {
        ("abcdef", 6, True, "abcd"), (None, 0, False, ""),
    }


def test_map_rows(spark):
    df = spark.range(100).repartition(4)
    doubled = map_rows(df, lambda batch: batch.assign(twice=batch["id"] * 2), "id bigint, twice bigint")
    assert doubled.where("twice <> id * 2").count() == 0 and doubled.count() == 100


@pytest.mark.parametrize("indented", [True, False])
def test_arrays_are_written_without_python_objects_of_their_texts(spark, tmp_path, monkeypatch, indented):
    """Batches pass Python as they are: pandas would hold several copies of 10,000 texts in every worker."""
    rows = spark.range(100).selectExpr("id", "concat('é\"', id) AS text").repartition(3)
    some = spark.range(0).selectExpr("id", "cast(id AS string) AS text").unionByName(rows)  # partitions without rows as well

    def refused(*_):
        raise AssertionError("pandas")

    monkeypatch.setattr(type(rows), "mapInPandas", refused)
    write_json_arrays(some, str(tmp_path / "arrays"), indented)
    found = [json.loads(text) for path in (tmp_path / "arrays").glob("part-*") if (text := path.read_text()).strip()]
    assert sorted((r["id"], r["text"]) for part in found for r in part) == [(i, f'é"{i}') for i in range(100)]
    assert found[0] and all(isinstance(part, list) for part in found)
