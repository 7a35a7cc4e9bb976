import random

import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from stormledger.llm import bpe
from stormledger.llm.queries import vocabulary_path


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


def mine(texts):
    encoder = bpe.Encoder(bpe.vocabulary(vocabulary_path()))
    encoder.learn(texts)
    return encoder.token_lists(texts).to_pylist()


def theirs(library, texts):
    return [library.encode(t or "", add_special_tokens=False).ids for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text(texts):
    assert mine(texts) == theirs(Tokenizer.from_file(vocabulary_path()), texts)


def test_special_strings_white_space_and_scripts(library):
    rng = random.Random(1)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|end", "'S", "'ll", "aaaa", "aaaaaaa", "İ", "Σ", "ß", "中文", "😀", "\x1c", "\x85", "　", "é", "é", " ", "\n", "12", "!?", "the", "Theory"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(3000)] + [None, "", "   ", "a" * 5000, "x " * 20000]
    assert mine(texts) == theirs(library, texts)


def test_operator_round_trip(spark, library, monkeypatch):
    rows = [(1, "Hello, World's end <|endoftext|> x"), (2, None), (3, ""), (1, "Hello, World's end <|endoftext|> x"), (None, "Ünïcode 42")]
    docs = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, ids string").repartition(2)
    tokens = bpe.encode(docs, vocabulary_path())
    got = bpe.decode(tokens, vocabulary_path()).collect()
    want = sorted((str(i), library.encode(t or "", add_special_tokens=False).ids) for i, t in rows)
    assert sorted((str(r.doc_id), r.ids) for r in got) == want
    assert all(r.decoded == library.decode(r.ids, skip_special_tokens=False) for r in got)
    odd = spark.createDataFrame([(1, [0, -1, 10**6, 1]), (2, None)], "doc_id long, ids array<int>")
    assert [r.decoded for r in bpe.decode(odd, vocabulary_path()).orderBy("doc_id").collect()] == ["! \"", ""]
    assert bpe.encode(docs.filter("doc_id > 9"), vocabulary_path()).count() == 0
