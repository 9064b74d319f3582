"""Token counts against the library whose model they follow."""

from pathlib import Path

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tagloom.llm.queries import QUERIES
from tagloom.llm.token_count import PieceMerges, with_token_counts

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def merges():
    return PieceMerges(Path(MODEL).read_bytes())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


PARTS = st.sampled_from(["a", "e", "the", "ing", " ", "  ", "\n", "\t", "\r", ";", "{", "=", "}", "<s>", "</s>", "<unk>", "<0x0A>", "▁", "é", "ß", "日本", "ｆ", "\x00", "🙂", "0", "12", "▁▁", "tion", "Q"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=60).map("".join))
def test_same_as_library(merges, library, text):
    assert merges.count(text) == len(library.encode(text))


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=40))
def test_any_text(merges, library, text):
    text = text.encode("utf-8", "ignore").decode()
    assert merges.count(text) == len(library.encode(text))


def test_long_texts(merges, library):
    for text in ("a" * 60_000, " " * 20_000, "ab;\r" * 9000, "word and " * 200_000, "x" * 1_100_000 + " y", "日" * 3000, "k9" * 30_000):
        assert merges.count(text) == len(library.encode(text))


def test_memory_of_chunks_is_bounded(merges, monkeypatch):
    monkeypatch.setattr("tagloom.llm.token_count.KEPT_CHUNKS", 10)
    merges.clear()
    assert merges.count(" ".join(map(str, range(500)))) == sum(merges.merged(f"▁{i}") for i in range(500))
    assert len(merges) <= 10


def test_rows(spark, library):
    rows = [(1, "two words", 9), (2, None, None), (3, "", 0), (1, "two words", 9), (None, "x " * 5000, 1), (4, "<s> \n", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    got = [tuple(r) for r in with_token_counts(docs, MODEL).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()]
    want = [(i, len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 4096) for i, t, _ in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    none = with_token_counts(docs.where("doc_id = 77"), MODEL, limit=1)
    assert none.columns == ["doc_id", "text", "n_tokens", "n_bytes", "over_limit"]
    assert none.count() == 0


@pytest.mark.skipif(not DATA.exists(), reason="no tables")
def test_query(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = QUERIES["op11_token_counts"](spark, str(DATA)).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        n = len(library.encode(texts[r["doc_id"]]))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 4096)
