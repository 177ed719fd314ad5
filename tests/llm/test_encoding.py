import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marlstone.llm import encoding
from marlstone.llm.vocabulary import Encoder, PerfectHash, read_ranks

pytestmark = pytest.mark.skipif(not os.path.exists(encoding.VOCABULARY), reason="no vocabulary file here")


@pytest.fixture(scope="module")
def encoder():
    return Encoder(read_ranks(encoding.VOCABULARY))


@pytest.fixture(scope="module")
def other():
    import tiktoken

    from marlstone.llm.vocabulary import PATTERN

    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(encoding.VOCABULARY), special_tokens={})


def test_hash_is_perfect_and_minimal():
    r = random.Random(1)
    keys = list({r.randbytes(r.randrange(1, 12)) for _ in range(5000)})
    h = PerfectHash(keys, list(range(len(keys))))
    assert len(h.keys) == len(keys) and [h.get(k) for k in keys] == list(range(len(keys)))
    assert all(h.get(k + b"\x00never") is None for k in keys[:500])
    assert PerfectHash([b"x"], [7]).get(b"x") == 7 and PerfectHash([b"x"], [7]).get(b"") is None


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_equals_a_public_encoder(encoder, other, text):
    assert list(encoder.encode(text)) == other.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 20000, "ab" * 5000 + "é" * 999, "<|endoftext|>", " \n\n\t x", "💻👩‍💻" * 50, "\x00\x7f", "ｆｕｌｌ", "в" * 3000])
def test_odd_texts(encoder, other, text):
    assert list(encoder.encode(text)) == other.encode_ordinary(text)
    assert other.decode(list(encoder.encode(text))) == text


def test_long_texts_are_encoded_the_same(encoder, monkeypatch):
    text = "Some words, 123 and é💻 " * 40
    short = list(encoder.encode(text))
    monkeypatch.setattr(Encoder, "LONG", 10)
    assert list(encoder.encode(text)) == short


def test_corpus(spark, encoder, monkeypatch):
    monkeypatch.setattr(encoding, "BATCH_IDS", 50)  # several batches
    rows = [(i, t, "clash") for i, t in enumerate(["", None, "hello world", "x" * 500, "hello world", "  "])] + [(None, "y", ""), (2, "hello world", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted((r.doc_id is None, r.doc_id or 0, list(r.ids)) for r in encoding.encode_corpus(df, "doc_id", "text").collect())
    assert got == sorted((k is None, k or 0, list(encoder.encode(t))) for k, t, _ in rows)
    assert encoding.encode_corpus(df.limit(0), "doc_id", "text").count() == 0


def test_incomplete_vocabulary():
    with pytest.raises(ValueError, match="lacks"):
        Encoder({b"a": 0})
