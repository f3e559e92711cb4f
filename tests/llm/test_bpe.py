import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pricecast.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def both():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return bpe.Encoder(bpe.read_ranks(PATH), P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(encoder, text):
    return np.frombuffer(encoder.encode([text])[0], "<u4").tolist()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="abtheing ", max_size=200))
def test_as_the_library(both, text):
    own, other = both
    assert ids(own, text) == other.encode_ordinary(text)
    assert own.decode(own.encode([text])[0]) == text.encode()


def test_long_pieces_and_texts(both, monkeypatch):
    own, other = both
    for text in ("ab" * 3000, "é" * 1500, "word " * 5000, "<|endoftext|> x", " \n\n  \t x"):
        assert ids(own, text) == other.encode_ordinary(text)
    monkeypatch.setattr(bpe, "GROUP", 50)
    monkeypatch.setattr(bpe, "BLOCK", 3)
    monkeypatch.setattr(bpe, "CACHED", 20)
    texts = ["a short one", None, "", "some longer text that has more than fifty characters in it " * 3, "tail"]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [other.encode_ordinary(t or "") for t in texts]


def test_columns(spark, odd, none, both):
    tokenizer = bpe.Tokenizer(spark, PATH, P.PATTERN)
    rows = tokenizer.decode(tokenizer.encode(odd)).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == both[1].encode_ordinary(r.text or "")
        assert hashlib.sha256(r.decoded).digest() == hashlib.sha256((r.text or "").encode()).digest()
    assert tokenizer.encode(none).count() == 0
