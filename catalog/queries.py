"""One query per operator; each takes the session and a folder of parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from catalog import views
from pairloom.functions import as_text, clean_text, collapse_whitespace, falsy, straighten_quotes
from pairloom.functions.text import PROMPT_HEAD, PROMPT_MIDDLE
from pairloom.operators import (
    cap_per_split,
    clean_pairs,
    count_by_split,
    count_raw_by_source,
    dedup_keep_first,
    export_text,
    first_row,
    length_budget,
    map_rows,
    pair_counts,
    project,
    resolve_aliases,
    resolve_pair,
    resolve_records,
    seeded_order,
    subword_tokenizer,
    tag,
    union_ordered,
    with_prompt,
)
from pairloom.plans import (
    Source,
    clean_and_split_folder,
    collect,
    prepare_training_set,
)
from pairloom.plans.clean_split import RAW_SCHEMA
from pairloom.session import new_folder
from pairloom.sources import (
    first_record,
    load_named_splits,
    load_split_files,
    materialise_if_absent,
    read_json_records,
    read_or_empty,
    scan,
    split_file_report,
    text_fields,
    write_json_arrays,
    write_json_texts,
    write_raw,
    write_splits,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# Queries whose results SQL cannot express; tests compare them with plain Python.
WITHOUT_SQL: dict[str, Query] = {}

# --- Fixed values ------------------------------------------------------------------------------
DOMAIN = "manufacturing_process_improvement"
FULL_RUN_CAPS = {"max_train": 2000, "max_validation": 200}
# ----------------------------------------------------------------------------------------------


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Scans -----------------------------------------------------------------------------------------


@query
def scan_dataset(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, f"{sf}/documents.parquet").drop("part")


@query
def scan_json_array(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "arrays")
    write_json_arrays(views.table(spark, sf, "documents").drop("part", "pos"), folder)
    records = read_json_records(spark, folder, "indented")
    doc_id = F.try_variant_get("v", "$.doc_id", "bigint").alias("doc_id")
    fields = text_fields(records.select(doc_id, "v"), ["text", "source", "n_chars"])
    return fields.withColumnRenamed("n_chars", "number_as_text")


@query
def scan_one_line_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Arrays without a line break, in blocks much smaller than a file."""
    folder = new_folder(spark, "arrays")
    write_json_arrays(views.table(spark, sf, "documents").drop("part", "pos"), folder, indented=False)
    records = read_json_records(spark, folder, "document")
    doc_id = F.try_variant_get("v", "$.doc_id", "bigint").alias("doc_id")
    return text_fields(records.select(doc_id, "v"), ["text", "source"])


@query
def scan_json_lines(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "lines")
    write_raw(views.b_raw(spark, sf), folder)
    records = read_json_records(spark, folder, "lines", landed=True)
    return text_fields(records, ["question", "answer", "no_such_field"]).drop("part")


@query
def load_named_splits_from_folder(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "splits")
    write_splits(views.splits(spark, sf), folder)
    return load_named_splits(spark, folder)


@query
def load_split_files_in_order(spark: SparkSession, sf: str) -> DataFrame:
    files = {"train": new_folder(spark, "train"), "validation": new_folder(spark, "validation")}
    for name, path in files.items():
        rows = views.named_splits(spark, sf).where(F.col("split") == name)
        in_order = rows.repartitionByRange("split_row").sortWithinPartitions("split_row")
        write_json_arrays(in_order.select("instruction", "response"), path)
    return load_split_files(spark, files)


@query
def optional_source(spark: SparkSession, sf: str) -> DataFrame:
    names = RAW_SCHEMA.names
    present, absent = [
        read_or_empty(
            spark,
            f"{sf}/{name}.parquet",
            RAW_SCHEMA,
            lambda spark, path: views.label_documents(scan(spark, path)).select(*names),
        )
        for name in ("documents", "no_such_table")
    ]
    return union_ordered([present, absent]).drop("part")


@query
def source_status(spark: SparkSession, sf: str) -> DataFrame:
    def resolve(df: DataFrame) -> DataFrame:
        return project(df, ["text", "source"])

    return collect(
        spark,
        [
            Source("good", f"{sf}/documents.parquet", resolve),
            Source("no_such_column", f"{sf}/conversations.parquet", resolve),
            Source("no_such_path", f"{sf}/no_such_table.parquet", resolve),
        ],
        new_folder(spark, "raw"),
    )


# Sinks -----------------------------------------------------------------------------------------


@query
def raw_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "raw")
    raw = views.a_raw(spark, sf).drop("part")
    write_raw(raw, folder)
    return spark.read.schema(raw.schema).json(folder)


@query
def split_write_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "splits")
    rows = views.splits(spark, sf)
    write_splits(rows, folder, "json")
    return spark.read.schema(rows.schema).json(folder)


@query
def materialise_twice(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "splits")
    materialise_if_absent(spark, folder, lambda: views.splits(spark, sf))
    materialise_if_absent(spark, folder, lambda: views.splits(spark, sf).where("split = 'test'"))
    return spark.read.parquet(folder)


@query
def split_sizes_on_disk(spark: SparkSession, sf: str) -> DataFrame:
    """Of plain text lines, whose size follows from the rows; with a split and a folder missing."""
    folder = new_folder(spark, "splits")
    lines = views.splits(spark, sf).where("split <> 'test'").select("split", "instruction")
    lines.write.partitionBy("split").option("compression", "none").text(folder)
    reports = [
        split_file_report(spark, path).select(F.lit(name).alias("folder"), "split", "present", "size_mb")
        for name, path in (("written", folder), ("absent", new_folder(spark, "no-splits")))
    ]
    return reports[0].unionByName(reports[1])


# Projections -----------------------------------------------------------------------------------


@query
def project_strict(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["instruction", "response", "category", "intent"]
    return project(views.a_raw(spark, sf), columns).drop("part")


@query
def resolve_aliases_by_name(spark: SparkSession, sf: str) -> DataFrame:
    # `question` is null for one language and must not give way to `instruction`.
    documents = views.table(spark, sf, "documents").select(
        "part",
        "pos",
        F.nullif("lang", F.lit("en")).alias("question"),
        F.col("text").alias("instruction"),
        F.col("source").alias("response"),
    )
    return resolve_aliases(documents).drop("part")


@query
def positional_fallback(spark: SparkSession, sf: str) -> DataFrame:
    return resolve_pair(views.c_raw(spark, sf)).drop("part")


@query
def positional_fallback_per_row(spark: SparkSession, sf: str) -> DataFrame:
    documents = views.table(spark, sf, "documents").select(
        "part",
        "pos",
        "source",
        "text",
        F.nullif("lang", F.lit("en")).alias("question"),
        F.when(F.col("lang") == "de", F.lit("")).otherwise(F.col("lang")).alias("answer"),
    )
    return resolve_pair(documents).drop("part")


@query
def positional_fallback_number(spark: SparkSession, sf: str) -> DataFrame:
    return resolve_pair(views.d_raw(spark, sf)).drop("part")


def _mixed_records(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as JSON texts whose keys differ from record to record, in presence and in order."""
    text, source, lang = (F.substr(F.to_json(F.struct(F.col(c).alias("x"))), F.lit(6)) for c in ("text", "source", "lang"))
    # Each ends in the brace of its object, which the last field of a record needs.
    field = lambda name, col: F.concat(F.lit(f'"{name}" : '), F.substr(col, F.lit(1), F.length(col) - 1))
    raw = lambda *parts: F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
    shapes = [
        raw(F.lit('"n": {"question": 1}'), field("answer", source), field("question", text), field("instruction", lang)),
        raw(field("response", lang), field("instruction", text)),
        raw(field("title", lang), field("body", text), field("answer", source)),
        raw(field("body", text), F.lit('"question": null'), field("instruction", lang), field("answer", source)),
        raw(F.lit('"answer": ""'), field("question", text)),
        raw(field("question", text), F.lit('"answer": [0]'), F.lit('"x": "}],"')),
        raw(field("a\\u0022}]b", text), F.lit('"question": 0'), F.lit('"answer": "0"')),
        raw(field("only", text)),
    ]
    chosen = F.coalesce(*[F.when(F.col("doc_id") % len(shapes) == k, shape) for k, shape in enumerate(shapes)])
    return views.table(spark, sf, "documents").select(chosen.alias("record"))


@query
def resolve_json_lines(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "lines")
    _mixed_records(spark, sf).write.text(folder)
    return resolve_records(read_json_records(spark, folder, "lines", raw=True)).drop("part", "pos")


@query
def resolve_json_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Collected from one-line arrays, next to a source that is no JSON."""
    folder, raw = new_folder(spark, "arrays"), new_folder(spark, "raw")
    write_json_texts(_mixed_records(spark, sf), folder)
    write_json_texts(_mixed_records(spark, sf).select(F.concat(F.lit("{"), "record")), f"{folder}-broken")
    sources = [
        Source(name, path, lambda df: tag(resolve_records(df), "domain", DOMAIN), layout="document")
        for name, path in (("broken", f"{folder}-broken"), ("arrays", folder))
    ]
    status = collect(spark, sources, raw)
    rows = spark.read.parquet(f"{raw}/arrays").drop("part", "pos").withColumn("source", F.lit("arrays"))
    return rows.join(status, "source", "left")


@query
def constant_tag(spark: SparkSession, sf: str) -> DataFrame:
    return tag(resolve_pair(views.b_raw(spark, sf)), "domain", DOMAIN).drop("part")


@query
def narrow_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return project(views.a_raw(spark, sf), ["instruction", "response"]).drop("part")


@query
def render_prompt(spark: SparkSession, sf: str) -> DataFrame:
    return with_prompt(views.pairs(spark, sf)).drop("part")


# Filter, union, dedup ---------------------------------------------------------------------------


@query
def filter_nonempty(spark: SparkSession, sf: str) -> DataFrame:
    # Unanswered turns and, in the second frame, rows whose instruction is a number are dropped.
    frames = [views.b_raw(spark, sf), views.d_raw(spark, sf)]
    return union_ordered([clean_pairs(resolve_pair(frame)) for frame in frames]).drop("part")


@query
def union_sources(spark: SparkSession, sf: str) -> DataFrame:
    return views.pairs(spark, sf).drop("part")


@query
def dedup_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_keep_first(views.pairs(spark, sf)).drop("part")


@query
def dedup_earlier_source_wins(spark: SparkSession, sf: str) -> DataFrame:
    frames = [views.a_raw(spark, sf), views.b_overlap(spark, sf)]
    return dedup_keep_first(union_ordered([clean_pairs(f) for f in frames])).drop("part")


@query
def dedup_hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    # A handful of keys, each with a large share of all rows.
    events = spark.read.parquet(f"{sf}/events.parquet")
    first = dedup_keep_first(events, "event_type", ("ts", "event_id"))
    return first.select("event_type", "event_id", "user_id", "value")


# Counts ----------------------------------------------------------------------------------------


@query
def count_raw(spark: SparkSession, sf: str) -> DataFrame:
    frames = {"a": views.a_raw(spark, sf), "b": resolve_pair(views.b_raw(spark, sf))}
    tagged = [
        tag(project(df, ["instruction"]), "source", name) for name, df in frames.items()
    ]
    return count_raw_by_source(union_ordered(tagged))


@query
def pair_totals(spark: SparkSession, sf: str) -> DataFrame:
    return pair_counts(views.pairs(spark, sf))


@query
def count_split_rows(spark: SparkSession, sf: str) -> DataFrame:
    return count_by_split(views.splits(spark, sf))


@query
def count_prepared(spark: SparkSession, sf: str) -> DataFrame:
    prepared = prepare_training_set(views.named_splits(spark, sf), **FULL_RUN_CAPS)
    return count_by_split(prepared, ("train", "validation"))


# Order, splits, caps -----------------------------------------------------------------------------


@query
def seeded_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    return seeded_order(views.pairs(spark, sf)).drop("part", "n_unique")


@query
def seeded_shuffle_hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    events = spark.read.parquet(f"{sf}/events.parquet")
    ordered = seeded_order(events, "event_type", ("ts", "event_id"))
    return ordered.select("event_type", "event_id", "user_id", "split_pos", "n_unique")


@query
def split_80_10_10(spark: SparkSession, sf: str) -> DataFrame:
    return views.splits(spark, sf).select("instruction", "split", "split_pos", "split_row")


@query
def cap_splits(spark: SparkSession, sf: str) -> DataFrame:
    return cap_per_split(views.named_splits(spark, sf), {"train": 500, "validation": None})


@query
def smoke_subset(spark: SparkSession, sf: str) -> DataFrame:
    return prepare_training_set(views.named_splits(spark, sf), **FULL_RUN_CAPS, smoke=True)


@query
def first_row_preview(spark: SparkSession, sf: str) -> DataFrame:
    return first_row(views.a_raw(spark, sf)).select("instruction")


@query
def first_record_preview(spark: SparkSession, sf: str) -> DataFrame:
    """Of a table, of several folders of which the first hold empty files, and of lines of text.

    As many files as ``spark.sql.shuffle.partitions`` and the size of the rows ask for.
    """
    folder, lines = new_folder(spark, "files"), new_folder(spark, "lines")
    rows = views.table(spark, sf, "documents").select("doc_id", "text")
    folders = [f"{folder}/{k}" for k in range(4)]
    for k, path in enumerate(folders):
        some = rows.where(F.lit(False)) if k < 3 else rows.where("doc_id > 10").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
        some.write.parquet(path)
    rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id").write.json(lines)
    found = {
        "table": first_record(spark, f"{sf}/documents.parquet").select("doc_id", "text"),
        "after empty files": first_record(spark, folders),
        "lines": first_record(spark, lines, "json", "doc_id bigint, text string"),
    }
    return reduce(DataFrame.unionByName, [d.select(F.lit(n).alias("source"), "doc_id", "text") for n, d in found.items()])


# Expressions -------------------------------------------------------------------------------------


@query
def type_guard(spark: SparkSession, sf: str) -> DataFrame:
    benchmark = views.table(spark, sf, "benchmark")
    return benchmark.select(
        "item_id",
        as_text("item_id", benchmark.schema["item_id"].dataType).alias("number_as_text"),
        as_text("text", benchmark.schema["text"].dataType).alias("text"),
    )


@query
def whitespace_collapsed(spark: SparkSession, sf: str) -> DataFrame:
    pages = views.table(spark, sf, "pages")
    return pages.select("page_id", collapse_whitespace("html").alias("html"))


@query
def quotes_straightened(spark: SparkSession, sf: str) -> DataFrame:
    quoted = F.concat(F.lit("“"), "text", F.lit("” ‘"), "source", F.lit("’"))
    return views.table(spark, sf, "documents").select(
        "doc_id", straighten_quotes(quoted).alias("text")
    )


@query
def clean_text_documents(spark: SparkSession, sf: str) -> DataFrame:
    wrapped = F.concat(F.lit("\u00a0\u2003“"), "text", F.lit("”\u001c\u3000"))
    return views.table(spark, sf, "documents").select(
        "doc_id", clean_text("text").alias("text"), clean_text(wrapped).alias("wrapped")
    )


@query
def clean_text_pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = views.table(spark, sf, "pages")
    return pages.select("page_id", clean_text("url").alias("url"), clean_text("html").alias("html"))


@query
def falsy_values(spark: SparkSession, sf: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    lang = F.col("lang")
    values = {
        "null_string": F.nullif(lang, F.lit("en")),
        "empty_string": F.when(lang == "de", F.lit("")).otherwise(lang),
        "number": F.col("toxic"),
        "flag": F.col("quality") == 1,
        "collection": F.when(lang == "de", F.array().cast("array<string>")).otherwise(F.array(lang)),
        "full_text": F.col("text"),
    }
    df = views.table(spark, sf, "documents").join(labels, "doc_id", "left")
    df = df.select("doc_id", *[value.alias(name) for name, value in values.items()])
    return df.select("doc_id", *[falsy(n, df.schema[n].dataType).alias(n) for n in values])


# Stages ------------------------------------------------------------------------------------------


def _collect_both(spark: SparkSession, sf: str, folder: str) -> None:
    collect(
        spark,
        [
            Source(
                "labelled",
                f"{sf}/documents.parquet",
                lambda df: project(
                    views.label_documents(df), ["instruction", "response", "category", "intent"]
                ),
            ),
            Source(
                "unnamed",
                f"{sf}/pages.parquet",
                lambda df: tag(
                    resolve_pair(df.select("part", "pos", "url", "html")), "domain", DOMAIN
                ),
            ),
        ],
        folder,
    )


@query
def collect_sources(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "raw")
    _collect_both(spark, sf, folder)
    landed = [
        tag(spark.read.parquet(f"{folder}/{name}"), "source", name)
        for name in ("labelled", "unnamed")
    ]
    return landed[0].unionByName(landed[1], allowMissingColumns=True).drop("part")


@query
def clean_split(spark: SparkSession, sf: str) -> DataFrame:
    return views.splits(spark, sf)


@query
def failed_source_then_split(spark: SparkSession, sf: str) -> DataFrame:
    """One source fails inside its tasks; the split goes on with the other."""

    def failing(df: DataFrame) -> DataFrame:
        broken = F.raise_error(F.concat(F.lit("broken row "), F.col("page_id"))).cast("string")
        return df.select("part", "pos", F.col("url").alias("instruction"), broken.alias("response"))

    raw, out = new_folder(spark, "raw"), new_folder(spark, "splits")
    sources = [
        Source("good", f"{sf}/documents.parquet", views.label_documents),
        Source("bad", f"{sf}/pages.parquet", failing),
    ]
    collect(spark, sources, raw)
    clean_and_split_folder(spark, raw, ["good", "bad"], out)
    return spark.read.parquet(out)


@query
def clean_split_folder(spark: SparkSession, sf: str) -> DataFrame:
    raw, out = new_folder(spark, "raw"), new_folder(spark, "splits")
    _collect_both(spark, sf, raw)
    clean_and_split_folder(spark, raw, ["labelled", "unnamed", "absent"], out)
    return spark.read.parquet(out)


@query
def prepare_training_rows(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "splits")
    write_splits(views.splits(spark, sf), folder)
    return prepare_training_set(load_named_splits(spark, folder))


@query
def map_rows_pandas(spark: SparkSession, sf: str) -> DataFrame:
    def prompt(batch: pd.DataFrame) -> pd.DataFrame:
        text = PROMPT_HEAD + batch["instruction"] + PROMPT_MIDDLE + batch["response"]
        return batch.assign(text=text)

    pairs = views.pairs(spark, sf).drop("part")
    text = T.StructField("text", T.StringType())
    return map_rows(pairs, prompt, T.StructType([*pairs.schema.fields, text]))


@query
def length_budget_512(spark: SparkSession, sf: str) -> DataFrame:
    prepared = prepare_training_set(views.named_splits(spark, sf))
    return length_budget(prepared).drop("instruction", "response", "text")


def length_budget_subwords(spark: SparkSession, sf: str) -> DataFrame:
    """In tokens of a public tokenizer, of whole documents."""
    import public_tokenizers

    tokenizer = subword_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    return length_budget(views.table(spark, sf, "documents").select("doc_id", "text"), tokenizer=tokenizer).drop("text")


WITHOUT_SQL["length_budget_subwords"] = length_budget_subwords


@query
def versioned_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Splits written three times, the last time by a job that fails; then collected, split and prepared anew."""
    folder, raw, out = new_folder(spark, "splits"), new_folder(spark, "raw"), new_folder(spark, "splits")
    rows = views.splits(spark, sf)
    write_splits(rows.where("split = 'test'"), folder, versioned=True)
    write_splits(rows, folder, versioned=True)
    broken = rows.withColumn("response", F.raise_error(F.lit("broken row")).cast("string"))
    with suppress(Exception):
        write_splits(broken, folder, versioned=True)
    sources = [Source("labelled", f"{sf}/documents.parquet", views.label_documents)]
    for _ in range(2):
        collect(spark, sources, raw, versioned=True)
        clean_and_split_folder(spark, raw, ["labelled", "absent"], out, versioned=True)
    return load_named_splits(spark, folder).withColumn("written", F.lit("twice")).unionByName(load_named_splits(spark, out).withColumn("written", F.lit("anew")))


@query
def export_training_text(spark: SparkSession, sf: str) -> DataFrame:
    return export_text(prepare_training_set(views.named_splits(spark, sf)))
