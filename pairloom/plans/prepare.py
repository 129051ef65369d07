"""Stage 3: the text that training reads."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pairloom.operators.order import cap_per_split
from pairloom.operators.train_text import with_prompt

# --- Fixed values: rows kept for a smoke run ---------------------------------------------------
SMOKE_CAPS = {"train": 50, "validation": 10}
# ----------------------------------------------------------------------------------------------


def prepare_training_set(
    splits: DataFrame,
    max_train: int | None = None,
    max_validation: int | None = None,
    smoke: bool = False,
) -> DataFrame:
    """Train and validation rows up to the caps, with their prompt in ``text``.

    A smoke run takes the first rows of what the caps leave; as both count from the first row,
    that is the smaller of the two numbers.
    """
    caps = {"train": max_train, "validation": max_validation}
    if smoke:
        caps = {
            name: few if caps[name] is None else min(few, caps[name])
            for name, few in SMOKE_CAPS.items()
        }
    return with_prompt(cap_per_split(splits, caps))
