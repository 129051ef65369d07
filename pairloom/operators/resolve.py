"""Finding the question and the answer in tables with differing columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pairloom.functions.text import as_text, falsy
from pairloom.operators.order import ORDER

# --- Fixed values: column names to look for, in this order ------------------------------------
QUESTION_NAMES = ("question", "instruction")
ANSWER_NAMES = ("answer", "response")
# ----------------------------------------------------------------------------------------------


def _named(df: DataFrame, names: Sequence[str]) -> tuple[Column, T.DataType]:
    for name in names:
        if name in df.columns:
            return F.col(name), df.schema[name].dataType
    return F.lit(""), T.StringType()


def _value_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ORDER]


def _kept(df: DataFrame) -> list[str]:
    return [c for c in ORDER if c in df.columns]


def _text(col: Column, dtype: T.DataType) -> Column:
    # A null string stays null here; only what is not a string at all becomes empty.
    return col if isinstance(dtype, T.StringType) else as_text(col, dtype)


def resolve_aliases(
    df: DataFrame,
    question_names: Sequence[str] = QUESTION_NAMES,
    answer_names: Sequence[str] = ANSWER_NAMES,
) -> DataFrame:
    """``instruction, response`` from the first listed column that exists, else ``''``.

    The choice is made by name, once for the table: a null in the chosen column stays null.
    """
    question, answer = _named(df, question_names), _named(df, answer_names)
    return df.select(
        *_kept(df), _text(*question).alias("instruction"), _text(*answer).alias("response")
    )


def positional_fallback(df: DataFrame, question: Column, answer: Column, use: Column) -> DataFrame:
    """Where ``use`` holds, both values come from the table's first two columns instead."""
    columns = _value_columns(df)
    first = _text(F.col(columns[0]), df.schema[columns[0]].dataType)
    second = F.lit("")
    if len(columns) > 1:
        second = _text(F.col(columns[1]), df.schema[columns[1]].dataType)
    return df.select(
        *_kept(df),
        F.when(use, first).otherwise(question).alias("instruction"),
        F.when(use, second).otherwise(answer).alias("response"),
    )


def resolve_pair(
    df: DataFrame,
    question_names: Sequence[str] = QUESTION_NAMES,
    answer_names: Sequence[str] = ANSWER_NAMES,
) -> DataFrame:
    """``resolve_aliases``, and ``positional_fallback`` for rows where either value is falsy.

    Tested on the values as they are: a blank string is not falsy, nor is a number other than 0.
    """
    question, answer = _named(df, question_names), _named(df, answer_names)
    return positional_fallback(
        df, _text(*question), _text(*answer), falsy(*question) | falsy(*answer)
    )


def resolve_records(
    records: DataFrame,
    question_names: Sequence[str] = QUESTION_NAMES,
    answer_names: Sequence[str] = ANSWER_NAMES,
) -> DataFrame:
    """``resolve_pair`` for JSON records (``read_json_records`` with ``raw``), decided for each by itself.

    No schema is inferred: a key counts as present if the record has it, also with null, and the fallback
    takes the record's own first two keys, in the order of its text. A second or first key that is not
    there gives ``''``. Null stays null, what is no string becomes empty. A record that is no object is
    an error, and so is one with a key twice, unless ``spark.sql.variant.allowDuplicateKeys`` lets the
    last value count.
    """
    keys = F.coalesce(
        F.array_distinct(F.json_object_keys("raw")),
        F.raise_error(F.concat(F.lit("a record is no object: "), F.substring(F.coalesce("raw", F.lit("")), 1, 40))).cast("array<string>"),
    )
    parsed = records.select(*_kept(records), keys.alias("_keys"), F.try_variant_get("v", "$", "map<string,variant>").alias("_values"))
    nothing = F.parse_json(F.lit('""'))

    def value(key: Column) -> Column:
        return F.when(F.array_contains("_keys", key), F.element_at("_values", key))

    def at(place: int) -> Column:
        # A place beyond the record's keys gives null, which no record contains.
        return F.coalesce(value(F.get("_keys", F.lit(place))), nothing)

    named = parsed.select(
        *_kept(records),
        *[F.coalesce(*[value(F.lit(n)) for n in names], nothing).alias(c) for c, names in (("_question", question_names), ("_answer", answer_names))],
        at(0).alias("_first"),
        at(1).alias("_second"),
    )
    use = falsy("_question", T.VariantType()) | falsy("_answer", T.VariantType())
    chosen = {"instruction": ("_first", "_question"), "response": ("_second", "_answer")}

    def text(name: str) -> Column:
        return F.when(~F.is_variant_null(name), as_text(name, T.VariantType()))

    return named.select(
        *_kept(records), *[F.when(use, text(place)).otherwise(text(key)).alias(c) for c, (place, key) in chosen.items()]
    )
