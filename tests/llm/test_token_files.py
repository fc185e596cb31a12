"""Token files: ids, order, pieces, indexes and checksums against the library and plain loops."""

import glob
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

tokenizers = pytest.importorskip("tokenizers")
from pyarrow import orc  # noqa: E402

from tidemark.llm import token_files as tf  # noqa: E402
from tidemark.llm.bpe import PATTERN, PLAIN_PATTERN  # noqa: E402
from tidemark.llm.common import shared_dir  # noqa: E402
from tidemark.llm.queries import QUERIES, vocabulary_path  # noqa: E402


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabulary_path())


def expected(rows, library):
    """Documents in file order, plainly: ``(doc_id, ids)``."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    return [(i, library.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in ordered]


def digests(coded):
    at, out = 0, []
    for i, ids in coded:
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


TEXTS = [None, "", "plain words here", "it's <|endoftext|> ok<|endoftext|>", "é日本 😀 x", "ab " * 9000, " \n\t  y  ", "a" * 5000, "<|endoftext", "word " * 4095 + "word"]


def test_table_with_long_and_odd_texts(spark, documents, library):
    rows = [(i * 7 % 10, t) for i, t in enumerate(TEXTS)]
    got = tf.round_trip(documents(rows), vocabulary_path()).collect()
    assert sorted(map(tuple, got)) == digests(expected(rows, library))


def test_repeated_ids_and_null_ids(spark, documents, library):
    rows = [(5, f"text {k % 3}") for k in range(400)] + [(None, "first"), (9, "z"), (1, None)]
    got = sorted(map(tuple, tf.round_trip(documents(rows), vocabulary_path()).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, 1] + [5] * 400 + [9]
    assert [r[1] for r in got] == list(np.cumsum([0] + [r[2] for r in got[:-1]]))
    want = sorted(tuple(ids) for _, ids in expected(rows, library))
    assert sorted((len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for i in want) == sorted((r[2], r[3]) for r in got)


def test_empty_table(spark, documents):
    folder = shared_dir(spark)
    tf.write_tokens(documents([]), folder, vocabulary_path())
    assert tf.read_tokens(spark, folder).count() == 0
    assert tf.document_checksums(tf.read_tokens(spark, folder)).collect() == []


def test_stretches_of_a_long_text(library, monkeypatch):
    text = "some words, 12 of   them\n" * 300 + "x" * 500 + " <|endoftext|> end"
    monkeypatch.setattr(tf, "STRETCH", 64)
    assert len(list(tf.stretches(text))) > 50
    assert "".join(tf.stretches(text)) == text
    ids, n = tf.Encoder(vocabulary_path()).encode([text, "", "é", text])
    one = library.encode(text, add_special_tokens=False).ids + [0]
    assert ids.tolist() == [*one, 0, *library.encode("é").ids, 0, *one] and n.tolist() == [len(one), 1, 1 + len(library.encode("é").ids), len(one)]


SPACES = " \n\t.!é<|>endoftextab's1\x1c\x85\xa0\u2003\u3000"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(SPACES), st.characters(exclude_categories=["Cs", "Cn"])), max_size=60), max_size=8))
def test_any_text(library, texts):
    ids, n = tf.Encoder.encode(CODER, texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == ([e.ids + [0] for e in library.encode_batch(texts, add_special_tokens=False)] or [[]])


CODER = tf.Encoder(vocabulary_path())


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(tf, "REMEMBERED", 20)
    texts = [f"word{i} other{i % 3} thing" for i in range(300)]
    coder = tf.Encoder(vocabulary_path())
    got = np.concatenate([coder.encode(texts[lo : lo + 50])[0] for lo in range(0, 300, 50)])
    assert got.tolist() == [i for e in library.encode_batch(texts, add_special_tokens=False) for i in [*e.ids, 0]]


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.one_of(st.text(st.sampled_from(SPACES + "''rvemld1é\0"), max_size=30), st.text(st.characters(exclude_categories=["Cs"]), max_size=30)), max_size=6))
def test_words_are_those_of_the_pattern(texts):
    import regex

    seen = []
    coder = tf.Encoder.__new__(tf.Encoder)
    coder.known = tf.Known(lambda words: [[seen.append(w) or len(seen) - 1] for w in words])
    places, n = coder.encode_parts(texts, [])
    want = [regex.findall(PATTERN, t) for t in texts]
    assert [seen[p] for p in places.tolist()] == [w for words in want for w in words]
    assert n.tolist() == [len(words) for words in want]


def test_known_words_cost_less_than_cutting_them_out():
    """CPU budget: repeated words must not become Python strings one by one."""
    texts = ["It's the same few words, again and again; 12 of them.\n" * 200] * 100
    coder = tf.Encoder(vocabulary_path())
    coder.encode(texts[:1])

    def least(task):
        took = []
        for _ in range(5):
            at = time.process_time()
            task()
            took.append(time.process_time() - at)
        return min(took)

    assert least(lambda: coder.encode(texts)) < least(lambda: [PLAIN_PATTERN.findall(t) for t in texts])


def test_words_met_last_are_kept():
    calls = []
    known = tf.Known(lambda words: [calls.append(w) or [ord(w), 7] for w in words])
    known.places([*"abcd"])
    known.places([*"ca"])
    known.forget(2)
    assert calls == [*"abcd"] and sorted(known) == ["a", "c"]
    ids, ends = known.gather(known.places([*"cba"]))
    assert ids.tolist() == [99, 7, 98, 7, 97, 7] and ends.tolist() == [2, 4, 6] and calls == [*"abcdb"]


def test_checksum_of_pieces():
    data = np.random.default_rng(1).bytes(1000)
    for cut in (0, 1, 4, 500, 999, 1000):
        a, b = data[:cut], data[cut:]
        assert tf.times(tf.zeros_after(len(b)), zlib.crc32(a)) ^ zlib.crc32(b) == zlib.crc32(data)


def test_files_have_stripes_indexes_and_filters(spark, documents, monkeypatch):
    monkeypatch.setattr(tf, "STRIPE_BYTES", 1 << 14)
    rng = np.random.default_rng(2)
    rows = [(3 * i, " ".join(map(str, rng.integers(0, 10**9, 40)))) for i in range(12_000)]
    folder = shared_dir(spark)
    tf.write_tokens(documents(rows), folder, vocabulary_path())
    files = [orc.ORCFile(f) for f in sorted(glob.glob(folder.removeprefix("file:") + "/tokens/part-*.orc"))]
    assert sum(f.nstripes for f in files) > len(files) and all(f.row_index_stride == tf.INDEX_ROWS for f in files)
    ids = [i for f in files for i in f.read(["doc_id"]).column(0).to_pylist()]
    assert ids == sorted(ids) == [i for i, _ in rows]
    # an id between two others is in the range of a stripe but in no filter
    def scanned(doc):
        df = tf.read_tokens(spark, folder, [doc]).select("doc_id")
        found = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [" in plan and "doc_id" in plan
        rows_read = spark.read.schema(tf.ROW).orc(f"{folder}/tokens").where(f"doc_id = {doc}")
        rows_read.collect()
        return [r.doc_id for r in found], leaf_rows(rows_read)

    hit, read = scanned(3 * 5000)
    assert hit == [15_000] and 0 < read <= 2 * tf.INDEX_ROWS
    miss, read = scanned(3 * 5000 + 1)
    assert miss == [] and read <= tf.INDEX_ROWS


def leaf_rows(df):
    """Rows that the file scan of an executed plan gave out."""
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_query_on_the_given_table(spark, sf, library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op11_token_files"](spark, sf).collect()))
    assert got == digests(expected(rows, library))
