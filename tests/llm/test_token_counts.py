import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pricecast.llm import token_counts

PATH = P.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "\n", "a", " a", "a  b   c    d", "x" * 3000, "ab" * 3000, " " * 700, "a" + " " * 41 + "b", "▁a ▁", "<s> </s> <unk> <0x41>",
       "日本語🙂のテキスト", "é ​ \x00\x07", "\t\r\n \n\n  x\ty", "the the the thethethe", "1234567890 3.14159 0x7f", "ÄÖÜß çédille Ñandú"]


@pytest.fixture(scope="module")
def both():
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    return token_counts.Counter(token_counts.read_pieces(PATH)), lambda t: len(library.encode(t or "", num_threads=1))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="abtheingſ ▁\n", max_size=300) | st.text(alphabet="a b", max_size=120))
def test_as_the_library(both, text):
    own, want = both
    assert own.count([text])[0] == want(text)


def test_odd_texts(both):
    own, want = both
    assert own.count([*ODD, None]) == [*map(want, ODD), 0]


def test_many_pretokens_side_by_side(both, monkeypatch):
    """Groups, batches, forgotten counts and the one-by-one form for long pre-tokens give the same numbers."""
    own, want = both
    texts = [*ODD, " ".join(ODD), "some longer text that has more than fifty characters in it " * 30]
    for name, value in (("GROUP", 50), ("BATCH", 60), ("CACHED", 20), ("LONG", 25)):
        monkeypatch.setattr(token_counts, name, value)
        assert own.count(texts) == list(map(want, texts))
        own.forget()


def test_very_long_texts(both):
    own, want = both
    for text in ("lorem ipsum dolor " * 60_000, "q9Z" * 40_000, " " * 100_000, "\n" * 100_000):
        assert own.count([text])[0] == want(text)


def test_columns(spark, odd, none, both):
    out = token_counts.count_tokens(odd, PATH)
    rows = out.collect()
    assert out.columns == [*odd.columns, "n_tokens"]
    assert len(rows) == odd.count()
    assert all(r.n_tokens == both[1](r.text) for r in rows)
    assert token_counts.count_tokens(none, PATH).count() == 0


def test_query(spark, both, tmp_path):
    from pricecast.llm import queries

    spark.createDataFrame([(1, "the word " * 3000), (2, None), (3, "é")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op12_token_counts(spark, str(tmp_path)).collect()}
    n = both[1]("the word " * 3000)
    assert got == {1: (27000, n, True), 2: (0, 0, False), 3: (2, both[1]("é"), False)}
    assert n > 4096
