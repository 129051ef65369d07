"""Table operators: DataFrame in, DataFrame out."""

from pairloom.operators.counts import count_by_split, count_raw_by_source, pair_counts
from pairloom.operators.order import ORDER, cap_per_split, assign_split, first_row, seeded_order
from pairloom.operators.pairs import clean_pairs, dedup_keep_first, project, tag, union_ordered
from pairloom.operators.resolve import positional_fallback, resolve_aliases, resolve_pair, resolve_records
from pairloom.operators.train_text import (
    WITHIN,
    export_text,
    length_budget,
    map_rows,
    subword_tokenizer,
    with_prompt,
)

__all__ = [
    "ORDER",
    "WITHIN",
    "assign_split",
    "cap_per_split",
    "clean_pairs",
    "count_by_split",
    "count_raw_by_source",
    "dedup_keep_first",
    "export_text",
    "first_row",
    "length_budget",
    "map_rows",
    "pair_counts",
    "positional_fallback",
    "project",
    "resolve_aliases",
    "resolve_pair",
    "resolve_records",
    "seeded_order",
    "subword_tokenizer",
    "tag",
    "union_ordered",
    "with_prompt",
]
