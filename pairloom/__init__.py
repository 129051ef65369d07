"""Instruction-data preparation on Spark: collect, clean, deduplicate, split and render."""

from pairloom.plans import (
    Source,
    clean_and_split,
    clean_and_split_folder,
    collect,
    prepare_training_set,
)

__all__ = [
    "Source",
    "clean_and_split",
    "clean_and_split_folder",
    "collect",
    "prepare_training_set",
]
