"""First rows, row numbers over many parts, versioned tables, sources side by side, subword budgets."""

from __future__ import annotations

import json
import subprocess
import sys
import threading
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from catalog.queries import QUERIES, WITHOUT_SQL
from pairloom.operators import first_row, length_budget, subword_tokenizer
from pairloom.plans import Source, clean_and_split_folder, collect
from pairloom.sources import first_record, load_named_splits, materialise_if_absent, readers, scan, split_file_report, versions, with_row_index, write_raw, write_splits

SF = "/root/testdata/sf0.01"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_read(df):
    """Number of files of the plan's scans, as Spark counts them when a plan first runs."""
    df = df.select("*")
    df.collect()
    found, nodes = 0, [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        if node.metrics().contains("numFiles"):
            found += node.metrics().apply("numFiles").value()
        children = [node.children().apply(k) for k in range(node.children().size())]
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            children.append(node.executedPlan())
        if node.getClass().getSimpleName() == "ResultQueryStageExec":
            children.append(node.plan())
        nodes += children
    return found


# First record ------------------------------------------------------------------------------------


def test_first_record_reads_one_file(spark, tmp_path):
    path = str(tmp_path / "a folder")
    spark.range(1000).repartitionByRange(9, "id").sortWithinPartitions("id").write.parquet(path)
    first = first_record(spark, path)
    assert [r.id for r in first.collect()] == [0]
    assert files_read(first) == 1 and files_read(scan(spark, path)) == 9


@pytest.mark.parametrize("n_empty", [0, 1, 2, 5, 23])
def test_empty_files_before_the_first_row(spark, tmp_path, n_empty):
    schema = "name string, n int"
    for k in range(n_empty):
        spark.createDataFrame([], schema).coalesce(1).write.parquet(str(tmp_path / f"{k:03d}"))
    spark.createDataFrame([("b", 1), ("a", 2)], schema).coalesce(1).write.parquet(str(tmp_path / "900"))
    spark.createDataFrame([("c", 3)], schema).coalesce(1).write.parquet(str(tmp_path / "901"))
    folders = sorted(str(p) for p in tmp_path.iterdir())
    found = first_record(spark, folders)
    assert [tuple(r) for r in found.collect()] == [("b", 1)]
    assert files_read(found) == 1
    assert [r.name for r in first_row(scan(spark, folders)).collect()] == ["b"]


def test_no_first_record(spark, tmp_path):
    spark.createDataFrame([], "a int").write.parquet(str(tmp_path / "p"))
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "1.jsonl").write_text("")
    for found in (first_record(spark, str(tmp_path / "p")), first_record(spark, str(tmp_path / "t"), "json", "a int")):
        assert found.columns == ["a"] and found.collect() == []


def test_first_record_of_text_in_blocks(spark, tmp_path):
    (tmp_path / "0.jsonl").write_text("")
    (tmp_path / "1.jsonl").write_text("\n".join(json.dumps({"n": k}) for k in range(5000)))
    (tmp_path / "2.jsonl").write_text('{"n": -1}')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    found = first_record(spark, str(tmp_path), "json", "n int")
    assert [r.n for r in found.collect()] == [0]
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


# Row index ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("at_once", [65_536, 7])
def test_rows_of_many_files_are_numbered_in_place(spark, tmp_path, monkeypatch, at_once):
    monkeypatch.setattr(readers, "BROADCAST_PARTS", at_once)
    spark.range(2000).withColumn("text", F.lit("x" * 50)).repartitionByRange(40, "id").sortWithinPartitions("id").write.parquet(str(tmp_path / "t"))
    numbered = with_row_index(scan(spark, str(tmp_path / "t")), "row")
    assert "Exchange hash" not in plan_of(numbered) and "SortMergeJoin" not in plan_of(numbered)
    assert sorted((r.id, r.row) for r in numbered.collect()) == [(k, k) for k in range(2000)]
    # Every range of parts opens its own files only.
    assert files_read(with_row_index(scan(spark, str(tmp_path / "t")), "row").select("text", "row")) == 40


def test_a_hundred_thousand_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "BROADCAST_PARTS", 30_000)
    rows = spark.range(200_000).select(F.lpad((F.col("id") / 2).cast("long").cast("string"), 7, "0").alias("part"), (F.col("id") % 2 + 5).alias("pos"), F.col("id"), F.lit("text").alias("text"))
    rows.write.parquet(str(tmp_path / "t"))
    numbered = with_row_index(scan(spark, str(tmp_path / "t"), landed=True), "row")
    assert plan_of(numbered).count("BroadcastHashJoin") >= 4 and "Exchange hash" not in plan_of(numbered)
    assert numbered.where("row <> id").count() == 0 and numbered.count() == 200_000


def test_one_large_file_is_split_and_numbered(spark, tmp_path):
    spark.range(50_000).withColumn("text", F.sha2(F.col("id").cast("string"), 256)).coalesce(1).write.option("parquet.block.size", 100_000).parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    numbered = with_row_index(scan(spark, str(tmp_path / "t")), "row")
    assert numbered.rdd.getNumPartitions() > 5
    assert numbered.where("row <> id").count() == 0
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_numbers_within_groups_across_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "BROADCAST_PARTS", 3)
    rows = [(s, f"p{k // 4:02d}", k % 4, f"{s}{k}") for s in "ab" for k in range(80)]
    spark.createDataFrame(rows, "split string, part string, pos long, name string").write.parquet(str(tmp_path / "t"))
    numbered = with_row_index(scan(spark, str(tmp_path / "t"), landed=True), "row", ("split",)).collect()
    assert sorted((r.name, r.row) for r in numbered) == sorted((f"{s}{k}", k) for s in "ab" for k in range(80))


# Versioned tables ----------------------------------------------------------------------------------


def table_of(spark, path):
    return sorted(r.n for r in scan(spark, path, landed=True).select("n").collect())


def numbers(spark, n, of=10):
    return spark.range(of).select(F.lit(n).alias("n"), F.lit("p").alias("part"), F.col("id").alias("pos"))


def test_a_version_replaces_the_other(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(5):
        assert write_raw(numbers(spark, n, n), path, "parquet", versioned=True) == n
        assert table_of(spark, path) == [n] * n
    assert versions.entry(spark, path)["rows"] == 4
    kept = sorted(p.name for p in (tmp_path / "t").iterdir())
    assert len([k for k in kept if k.startswith(versions.DATA)]) == versions.KEPT
    with pytest.raises(Exception):
        spark.read.parquet(path).collect()  # a plain reader sees nothing, rather than several versions


@pytest.mark.parametrize("step", ["data", "entry", "rename", "clean", "delete"])
def test_a_crash_at_any_step_leaves_one_whole_table(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    write_raw(numbers(spark, 1), path, "parquet", versioned=True)
    write_raw(numbers(spark, 2), path, "parquet", versioned=True)

    class Crash(BaseException):
        """Not an Exception: nothing is tidied up after it."""

    def crash(*args, **kwargs):
        raise Crash

    rows = numbers(spark, 3)
    with monkeypatch.context() as patch:
        if step == "data":
            rows = rows.withColumn("n", F.when(F.col("pos") == 9, F.raise_error(F.lit("x")).cast("int")).otherwise(3))
        elif step == "entry":
            patch.setattr(versions.json, "dumps", crash)
        elif step == "rename":
            real = versions._system
            patch.setattr(versions, "_system", lambda spark, p: crash() if p.rsplit("/", 1)[-1].isdigit() else real(spark, p))
        elif step == "clean":
            patch.setattr(versions, "clean", crash)
        else:
            patch.setattr(versions, "delete_folder", crash)
        with pytest.raises((Crash, Exception)):
            write_raw(rows, path, "parquet", versioned=True)
    assert table_of(spark, path) == [3 if step in ("clean", "delete") else 2] * 10
    write_raw(numbers(spark, 4), path, "parquet", versioned=True)
    assert table_of(spark, path) == [4] * 10
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith(versions.DATA)]) == versions.KEPT
    assert len([p for p in (tmp_path / "t" / versions.LOG).iterdir() if not p.name.endswith(".crc")]) == versions.KEPT


def test_readers_see_whole_tables_while_they_change(spark, tmp_path, monkeypatch):
    path, seen, done = str(tmp_path / "t"), [], threading.Event()
    monkeypatch.setattr(versions, "KEPT", 50)
    monkeypatch.setattr(versions.clean, "__defaults__", (50,))
    monkeypatch.setattr(versions.commit, "__defaults__", (50,))
    write_raw(numbers(spark, 0), path, "parquet", versioned=True)

    def watch():
        while not done.is_set():
            try:
                seen.append(table_of(spark, path))
            except Exception as error:
                seen.append(error)

    watcher = threading.Thread(target=watch)
    watcher.start()
    for n in range(1, 8):
        write_raw(numbers(spark, n), path, "parquet", versioned=True)
    done.set()
    watcher.join()
    assert all(isinstance(x, list) and len(x) == 10 and len(set(x)) == 1 for x in seen), seen
    firsts = [x[0] for x in seen]
    assert firsts == sorted(firsts) and len(set(firsts)) > 1


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    write_raw(numbers(spark, 1), path, "parquet", versioned=True)
    folder = versions.new_version(path)
    numbers(spark, 2).write.parquet(folder)
    (tmp_path / "t" / versions.LOG / f"{2:020d}").write_text(json.dumps({"data": folder.rsplit("/", 1)[1]}))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(versions, "_entries", lambda spark, p: [f"{1:020d}"])
        with pytest.raises(OSError, match="another write"):
            versions.commit(spark, path, folder)
    assert table_of(spark, path) == [2] * 10


def test_stages_over_versioned_tables(spark, tmp_path):
    rows = [(f"q{i % 30}", f"a{i}") for i in range(300)]
    spark.createDataFrame(rows, "instruction string, response string").coalesce(1).write.parquet(str(tmp_path / "src"))
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    for _ in range(2):
        status = collect(spark, [Source("one", str(tmp_path / "src"), lambda df: df)], raw, versioned=True)
        assert [tuple(r) for r in status.collect()] == [("one", "saved", 300)]
        clean_and_split_folder(spark, raw, ["one", "none"], out, versioned=True)
    assert {r.split: r["count"] for r in load_named_splits(spark, out).groupBy("split").count().collect()} == {"train": 24, "validation": 3}
    assert all(r.present for r in split_file_report(spark, out).collect())
    materialise_if_absent(spark, out, lambda: 1 / 0)
    write_splits(load_named_splits(spark, out, names={"train": "train"}), str(tmp_path / "plain"))
    assert load_named_splits(spark, str(tmp_path / "plain")).count() == 24


# Sources side by side --------------------------------------------------------------------------------


def test_a_slow_source_does_not_delay_the_others(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "src"))
    started, ended = {}, {}
    gate = threading.Event()

    def resolve(name):
        def run(df):
            started[name] = time.monotonic()
            if name == "slow":
                gate.wait(60)
            if name == "bad":
                raise KeyError("x")
            if name == "last":
                gate.set()
            ended[name] = time.monotonic()
            return df

        return run

    sources = [Source(n, str(tmp_path / "src"), resolve(n)) for n in ("slow", "bad", "quick", "last")]
    status = collect(spark, sources, str(tmp_path / "raw"))
    assert [tuple(r) for r in status.collect()] == [("slow", "saved", 5), ("bad", "failed", 0), ("quick", "saved", 5), ("last", "saved", 5)]
    assert ended["slow"] > ended["last"] and ended["slow"] > ended["quick"]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_every_source_runs_in_its_pool_and_keeps_the_job_group(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "src"))
    seen = {}

    def resolve(df):
        pool = df.sparkSession.sparkContext.getLocalProperty("spark.scheduler.pool")
        seen[pool] = df.sparkSession.sparkContext.getLocalProperty("spark.jobGroup.id")
        return df

    spark.sparkContext.setJobGroup("a-group", "")
    collect(spark, [Source(n, str(tmp_path / "src"), resolve) for n in "abc"], str(tmp_path / "raw"), at_once=2)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert seen == {f"collect-{n}": "a-group" for n in "abc"}
    with pytest.raises(ValueError, match="several sources"):
        collect(spark, [Source("a", "x", resolve), Source("a", "y", resolve)], str(tmp_path / "raw"))
    assert collect(spark, [], str(tmp_path / "raw")).collect() == []


# Subword budgets -------------------------------------------------------------------------------------


def test_subword_budgets_equal_plain_tokenization(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = {r.doc_id: r for r in WITHOUT_SQL["length_budget_subwords"](spark, SF).collect()}
    texts = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(texts) and any(r.over_budget for r in rows.values())
    for doc in texts:
        found, row = model.encode(doc.text, add_special_tokens=False), rows[doc.doc_id]
        cut = doc.text if len(found) <= 512 else doc.text[: found.offsets[512][0]]
        assert (row.n_tokens, row.over_budget, row.budget_text) == (len(found), len(found) > 512, cut)


def test_subword_budget_of_odd_texts(spark):
    import public_tokenizers

    texts = ["", None, "a", "é" * 50, "\U0001f600" * 50, "word " * 100_000, " \n\t "]
    load = subword_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    got = length_budget(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string"), max_tokens=7, tokenizer=load).orderBy("k").collect()
    for row in got:
        text = row.text or ""
        assert text.startswith(row.budget_text) and row.over_budget == (row.n_tokens > 7)
        assert row.budget_text == text if row.n_tokens <= 7 else len(row.budget_text) < len(text)
    tokenize = load()
    assert all(n <= 7 for n, _ in tokenize([r.budget_text for r in got], 7))


# The contract ------------------------------------------------------------------------------------------


def test_queries_without_sql_are_registered():
    assert set(WITHOUT_SQL) <= set(contract.queries()) and not set(WITHOUT_SQL) & set(QUERIES)


def test_a_package_that_only_corpus_operators_need_may_be_missing():
    script = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as c; from catalog.queries import QUERIES; assert set(QUERIES) <= set(c.queries()); print(len(c.queries()))"
    run = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, check=True, timeout=120, cwd=str(__import__("pathlib").Path(contract.__file__).parent))
    assert int(run.stdout) == len(QUERIES) + len(WITHOUT_SQL)


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return [name for name in blocks.mkString("\n").split("\n") if "shuffle_" in name]


def test_written_tables_take_little_disk(spark, tmp_path):
    """Parquet is compressed well, and what a write has shuffled is gone when it ends, also when it fails."""
    rows = numbers(spark, 1, 300).withColumn("split", F.lit("train")).repartition(3, "pos")
    rows.write.parquet(str(tmp_path / "plain"))  # by Spark alone: its shuffle stays
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, held = spark.conf.get(name), set(shuffle_files(spark))
    assert held
    write_splits(rows, str(tmp_path / "splits"), versioned=True)
    with pytest.raises(Exception, match="broken"):
        write_splits(rows.withColumn("n", F.raise_error(F.lit("broken"))), str(tmp_path / "splits"), versioned=True)
    spark.range(0, 300, 1, 4).write.parquet(str(tmp_path / "src"))
    assert collect(spark, [Source("one", str(tmp_path / "src"), lambda df: df.repartition(3, "id"))], str(tmp_path / "raw"), "parquet").head().status == "saved"
    assert not set(shuffle_files(spark)) - held
    assert spark.conf.get(name) == before
    for folder in ("splits", "raw"):
        files = [*(tmp_path / folder).rglob("*.parquet")]
        assert files and all(pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD" for f in files)
