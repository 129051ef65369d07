"""The text column that training reads, and its length."""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from pairloom.functions.text import collapse_whitespace, render_prompt

# Order within the prepared splits.
WITHIN = ("split", "split_row")

# Words of a tokenizer whose sizes a task keeps, and their longest.
WORDS_KEPT = 500_000
WORD_KEPT = 64

# A function from texts to (number of tokens, text of the first max_tokens tokens).
Tokenizer = Callable[[Sequence[str], int], Sequence[tuple[int, str]]]


def with_prompt(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the rendered prompt, keeping the other columns."""
    return df.withColumn(text_col, render_prompt(F.col("instruction"), F.col("response")))


def map_rows(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str
) -> DataFrame:
    """A user's function over the rows, given and returning Arrow-fed pandas batches."""

    def over_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(over_batches, schema)


def length_budget(
    df: DataFrame,
    text_col: str = "text",
    max_tokens: int = 512,
    tokenizer: Callable[[], Tokenizer] | None = None,
) -> DataFrame:
    """Adds ``n_tokens``, ``over_budget`` and ``budget_text``, the first ``max_tokens`` tokens.

    A token is a word between whitespace unless ``tokenizer`` is given; word counts are lower than
    the subword counts of a model. ``tokenizer`` is called once per task, to load the model there
    (``subword_tokenizer``).
    """
    if tokenizer is not None:
        return _model_budget(df, text_col, max_tokens, tokenizer)
    words = F.coalesce(collapse_whitespace(text_col), F.lit(""))
    gaps = F.length("_words") - F.length(F.replace("_words", F.lit(" "), F.lit("")))
    n_tokens = F.when(F.col("_words") == "", 0).otherwise(gaps + 1).cast("bigint")
    return (
        df.withColumn("_words", words)
        .withColumn("n_tokens", n_tokens)
        .withColumn("over_budget", F.col("n_tokens") > max_tokens)
        .withColumn("budget_text", F.substring_index("_words", " ", max_tokens))
        .drop("_words")
    )


def subword_tokenizer(path: str) -> Callable[[], Tokenizer]:
    """For ``length_budget``: tokens of the ``tokenizer.json`` at ``path``, without special ones.

    The file is read here and sent along, so executors need not see it. A text over the budget is cut where its
    first token beyond the budget begins; a character that the cut goes through falls to the rest, so the part
    is a prefix of the text and never has characters of more than ``max_tokens`` tokens.
    """
    with open(path, encoding="utf-8") as file:
        content = file.read()

    def load() -> Tokenizer:
        import os

        # A task has one core; threads of its own would take those of others.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as Model

        model = Model.from_str(content)
        model.no_truncation()
        model.no_padding()
        described = json.loads(content)
        added = [a["content"] for a in described.get("added_tokens") or []]
        separable = _separable(described)

        def whole(texts: list[str], max_tokens: int) -> Iterator[tuple[int, str]]:
            for text, found in zip(texts, model.encode_batch(texts, add_special_tokens=False)):
                n = len(found)
                yield n, text if n <= max_tokens else text[: found.offsets[max_tokens][0]]

        def tokenize(texts: Sequence[str], max_tokens: int) -> Iterator[tuple[int, str]]:
            # A few at a time, as the tokens of a text take many times its size.
            for start in range(0, len(texts), 64):
                yield from whole(list(texts[start : start + 64]), max_tokens)

        sizes: dict[str, int] = {}

        def by_word(texts: Sequence[str], max_tokens: int) -> Iterator[tuple[int, str]]:
            for text in texts:
                words = text.split(" ")
                words[1:] = [" " + w for w in words[1:]]
                if any(a in text for a in added):
                    yield from whole([text], max_tokens)
                    continue
                counts = [*map(sizes.get, words)]
                if None in counts:
                    new = list({w for w, n in zip(words, counts) if n is None})
                    if any(_open_ended(w) for w in new):
                        words = _joined(words)
                        new = [w for w in dict.fromkeys(words) if w not in sizes]
                    if len(sizes) > WORDS_KEPT:
                        sizes.clear()
                        new = list(dict.fromkeys(words))
                    found = {w: len(e) for k in range(0, len(new), 1024) for w, e in zip(new[k : k + 1024], model.encode_batch_fast(new[k : k + 1024], add_special_tokens=False))}
                    # A word that ends in white space may be told apart by what follows, so it is not kept.
                    sizes.update((w, n) for w, n in found.items() if len(w) <= WORD_KEPT and not _open_ended(w))
                    counts = [found[w] if w in found else sizes[w] for w in words]
                ends = list(accumulate(counts))
                n = ends[-1]
                if n <= max_tokens:
                    yield n, text
                    continue
                k = bisect_right(ends, max_tokens)
                inside = max_tokens - (ends[k - 1] if k else 0)
                offset = model.encode(words[k], add_special_tokens=False).offsets[inside][0]
                yield n, text[: sum(map(len, words[:k])) + offset]

        return by_word if separable else tokenize

    return load


def _separable(described: dict) -> bool:
    """Whether a tokenizer gives the same tokens to a text's words, each with the space before it, as to the text.

    Byte-level splitting puts no white space after other characters into one piece, looks at nothing before a piece,
    and merges within pieces only. Anything else in the file (a normalizer, a prefix space, dropout) is left to
    the model, and so are texts that hold one of its added tokens.
    """
    splits, merges = described.get("pre_tokenizer") or {}, described.get("model") or {}
    return (
        splits.get("type") == "ByteLevel" and splits.get("use_regex", True) and not splits.get("add_prefix_space", True)
        and merges.get("type") == "BPE" and not merges.get("dropout")
        and not any(merges.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix", "unk_token"))
        and not described.get("normalizer") and not described.get("post_processor")
        and len(described.get("added_tokens") or []) <= 16
    )


def _open_ended(word: str) -> bool:
    """Whether a word is empty or ends in what may be white space, so that a space after it is no place to cut."""
    return not word or word[-1].isspace() or not word[-1].isprintable()


def _joined(words: list[str]) -> list[str]:
    """The words of a text, cut before a space only where no white space is before it."""
    out: list[str] = []
    for word in words:
        if out and _open_ended(out[-1]):
            out[-1] += word
        else:
            out.append(word)
    return out


def _model_budget(
    df: DataFrame, text_col: str, max_tokens: int, tokenizer: Callable[[], Tokenizer]
) -> DataFrame:
    @F.pandas_udf("n_tokens bigint, budget_text string")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tokenize = tokenizer()
        for texts in batches:
            rows = list(tokenize(texts.fillna("").tolist(), max_tokens))
            yield pd.DataFrame(rows, columns=["n_tokens", "budget_text"])

    return df.withColumn("_measured", measure(text_col)).select(
        *df.columns,
        F.col("_measured.n_tokens").alias("n_tokens"),
        (F.col("_measured.n_tokens") > max_tokens).alias("over_budget"),
        F.col("_measured.budget_text").alias("budget_text"),
    )


def export_text(df: DataFrame, text_col: str = "text") -> DataFrame:
    """What a trainer is given: the text column with its place."""
    return df.select(*WITHIN, F.col(text_col).alias("text"))
