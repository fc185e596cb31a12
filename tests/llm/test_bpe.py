"""Encoding and decoding against the vocabulary's own library."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

tokenizers = pytest.importorskip("tokenizers")
from tidemark.llm import bpe  # noqa: E402
from tidemark.llm.queries import QUERIES, vocabulary_path  # noqa: E402


@pytest.fixture(scope="module")
def theirs():
    return tokenizers.Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def ours():
    return bpe.vocabulary(vocabulary_path())


def same(texts, ours, theirs):
    expected = [e.ids for e in theirs.encode_batch(texts, add_special_tokens=False)]
    assert ours.encode(list(texts)) == expected
    for ids in expected:
        assert ours.decode(ids) == theirs.decode(ids, skip_special_tokens=False)


ODD = ["", " ", "a" * 3000, " " * 1500, "ab" * 900, "=-" * 700, "<|endoftext|>", "x<|endoftext|>y <|endoftext|><|endoftext", "it's we'LL 've", "\x1c\x1d\x85\xa0　x", "\x00\x7f", "²½Ⅷ٣ 123abc", "日本語 한국어 😀👍🏽", "é" * 400]


def test_odd_texts(ours, theirs):
    same(ODD, ours, theirs)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" 'stredonthing\n\t.!é<|>"), st.characters(exclude_categories=["Cs", "Cn"])), max_size=60), max_size=8))
def test_any_text(ours, theirs, texts):
    same(texts, ours, theirs)


def test_exact_merging_agrees_with_scanning(ours):
    for word in (b"thionthtionhereanding", b"aaaaaaaaaaaa", b"\xc3\xa9\xc3\xa9x", b"a"):
        assert ours.merge_exactly(word) == ours.merge_short(word)


def test_forgetting_words_changes_nothing(theirs, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    fresh = bpe.Vocabulary(vocabulary_path())
    same([f"word{i} other{i % 3} thing" for i in range(1200)], fresh, theirs)


def test_table(spark, documents):
    path = vocabulary_path()
    rows = bpe.decode(bpe.encode(documents([(1, "ab cd"), (1, "ab cd"), (2, None), (None, ""), (3, "x" * 90_000)]), path), path).collect()
    assert len(rows) == 5
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[2]["ids"] == [] and by_id[2]["decoded"] == ""
    assert by_id[3]["decoded"] == "x" * 90_000
    assert bpe.encode(documents([]), path).count() == 0


def test_query(spark, sf, theirs):
    import hashlib

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op1_bpe_round_trip"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = theirs.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
