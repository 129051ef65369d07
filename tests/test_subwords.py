"""Subword budgets counted by word, against plain tokenization of whole texts."""

from __future__ import annotations

import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pairloom.operators import subword_tokenizer, train_text

PIECES = [
    " ", "  ", "\n", "\t", "\r", "\xa0", " ", "　", "\x1c", "\x85", "​", "﻿", "\x00", "a", "word", "'s", " 's", "é",
    "\U0001f600", "中", "12", "½", "...", "<|endoftext|>", "<|endo", "_", "-",
]


def plain(model, text, most):
    found = model.encode(text, add_special_tokens=False)
    return len(found), text if len(found) <= most else text[: found.offsets[most][0]]


@pytest.mark.parametrize("kept", [500_000, 20])
def test_random_texts_give_the_tokens_of_the_whole_text(monkeypatch, kept):
    monkeypatch.setattr(train_text, "WORDS_KEPT", kept)
    path = public_tokenizers.path("byte_bpe_50k.json")
    model, tokenize, draw = Tokenizer.from_file(path), subword_tokenizer(path)(), random.Random(4)
    for _ in range(3000):
        text, most = "".join(draw.choice(PIECES) for _ in range(draw.randrange(14))), draw.randrange(1, 9)
        assert list(tokenize([text], most)) == [plain(model, text, most)], (text, most)


def test_words_are_tokenized_once(monkeypatch):
    """Whole texts are left to the model only if words do not give their tokens."""
    import tokenizers

    given = []

    class Counted:
        def __init__(self, model):
            self.model = model

        def __getattr__(self, name):
            method = getattr(self.model, name)
            if name.startswith("encode_batch"):
                return lambda texts, **more: given.extend(texts) or method(texts, **more)
            return method

        @staticmethod
        def from_str(content):
            return Counted(Tokenizer.from_str(content))

    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    content = json.loads(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())
    text = "some words and some words again " * 50
    assert next(subword_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))()([text], 512))[0] > 250
    assert sum(map(len, given)) < 100
    for changed in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {**content["pre_tokenizer"], "add_prefix_space": True}}):
        assert not train_text._separable({**content, **changed})
    assert train_text._separable(content)
