"""Tree concatenation must give the library's ids, and decoding the texts."""

import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgersift.llm import bpe

PIECES = [
    "a", "the", "ing", "'s", "'re", "'", " ", "  ", "\n", "\t", "<|endoftext|>", "<|", "|>", "1", "23", "é", "日本",
    "\U0001f600", "!", "?!", "'ll", "Z", "lowei", " the", "===", " ", "́",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))


ENCODER = bpe.TreeEncoder(bpe._vocabulary(None))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=200), st.sampled_from([1, 3, 8, 40]))
def test_same_ids_as_library(library, pieces, leaf):
    text = "".join(pieces)
    ENCODER.leaf_chars = leaf
    want = library.encode(text, add_special_tokens=False).ids
    assert ENCODER.encode([text])[0] == want
    assert ENCODER.decode(want) == library.decode(want, skip_special_tokens=False)


def test_long_unsplit_texts(library):
    rng = random.Random(2)
    for text in ("x" * 50_000, "".join(rng.choice("abcde") for _ in range(60_000)), "漢字" * 9_000, " " * 20_000, "ab \n" * 9_000):
        ENCODER.leaf_chars = 1000
        assert ENCODER.encode([text])[0] == library.encode(text, add_special_tokens=False).ids


def test_query_columns(spark, library):
    texts = [None, "", "plain text", "x" * 9000, "<|endoftext|> end", "퟿"]
    rows = [(i, t, "z", 7) for i, t in enumerate(texts)] + [(2, "plain text", "z", 7), (None, "no id", "z", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, n_tokens int")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = sorted((tuple(r) for r in bpe.digests(docs, leaf_chars=64).collect()), key=str)
    want = []
    for i, t, _, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want, key=str)
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(docs)).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(texts))
    assert bpe.digests(docs.where("false")).count() == 0
