"""The automaton against the tokenizers library: exact ids, exact decoding."""

from __future__ import annotations

import hashlib
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pairloom.llm import bpe
from pairloom.llm.queries import QUERIES, table

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def automaton():
    return bpe.MergeAutomaton(open(PATH, encoding="utf-8").read())


def unpack(packed: bytes) -> list[int]:
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


EDGES = ["", " ", "  ", "a  b", "a   b ", "x \n y", "a" * 3000, " " * 500, "it's 12 ok", " a",
         "the<|endoftext|> x <|endoftext|>", "<|endoftext", "漢字😀 é́", "\x00\x1c\x85​"]


@pytest.mark.parametrize("text", EDGES)
def test_edge_texts(automaton, library, text):
    packed = automaton.encode(text)
    ids = library.encode(text, add_special_tokens=False).ids
    assert unpack(packed) == ids
    assert automaton.decode(packed) == library.decode(ids, skip_special_tokens=False)


def test_random_texts(automaton, library):
    draw = random.Random(5)
    letters = " \t\n\r  aabetoinrsé'sdt漢😀9٣Ⅷ!?<|>"
    for _ in range(4000):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 30)))
        assert unpack(automaton.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_small_grammar_equals_applying_merges_in_order():
    """Every string over two letters, with merges that overlap themselves and each other."""
    merges = [("a", "a"), ("b", "a"), ("aa", "b"), ("aa", "aa"), ("a", "b"), ("ba", "aab")]
    vocab = {c: i for i, c in enumerate(bpe.byte_letters())}
    for u, v in merges:
        vocab.setdefault(u + v, len(vocab))
    import json

    spec = {"model": {"vocab": vocab, "merges": [list(m) for m in merges]}, "added_tokens": []}
    automaton = bpe.MergeAutomaton(json.dumps(spec))
    for n in range(1, 11):
        for bits in range(2**n):
            word = "".join("ab"[bits >> k & 1] for k in range(n))
            tokens = list(word)
            while True:
                ranked = [(merges.index(p), k) for k, p in enumerate(zip(tokens, tokens[1:])) if p in merges]
                if not ranked:
                    break
                rank, k = min(ranked)
                tokens[k : k + 2] = ["".join(merges[rank])]
            assert automaton.encode_word(word.encode()) == [vocab[t] for t in tokens], word


def test_bytes_that_are_no_text(automaton, library):
    broken = [library.encode("é", add_special_tokens=False).ids[0], 222, 0, 162]
    packed = struct.pack("<4I", *broken)
    assert automaton.decode(packed) == library.decode(broken, skip_special_tokens=False)


def test_table_with_nulls_clashes_and_no_rows(spark):
    rows = [(1, None, "x", 5), (None, "", "y", None), (1, "a b", None, 6), (1, "a b", None, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids string, n_tokens int")
    out = bpe.encode(docs, PATH, decoded=True)
    assert out.columns == [*docs.columns, "n_tokens_", "token_ids_", "decoded"]
    got = sorted((r.n_tokens_, r.decoded) for r in out.collect())
    assert got == [(0, ""), (0, ""), (2, "a b"), (2, "a b")]
    assert bpe.encode(docs.limit(0), PATH).count() == 0
    back = bpe.decode(out, PATH, "token_ids_")
    assert back.where("decoded <> decoded_").count() == 0


def test_query_equals_library(spark, library):
    texts = {r.doc_id: r.text or "" for r in table(spark, SF, "documents").collect()}
    rows = QUERIES["op1_bpe"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        plain = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(plain.encode()).hexdigest()
