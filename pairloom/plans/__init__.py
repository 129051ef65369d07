"""The stages as a user runs them, composed from sources and operators."""

from pairloom.plans.clean_split import clean_and_split, clean_and_split_folder
from pairloom.plans.collect import Source, collect
from pairloom.plans.prepare import prepare_training_set

__all__ = [
    "Source",
    "clean_and_split",
    "clean_and_split_folder",
    "collect",
    "prepare_training_set",
]
