"""The pipeline's stages, each on its own input."""

import corpus_pipeline as pipeline
import pytest
from tidemark.llm.secrets import MASK

WORDS = ["the", "and", "of", "that", "with", "this", "from", "have", "where", "other", "which", "their"]


def sentence(seed, n=40):
    return " ".join(WORDS[(seed * 7 + i * i) % 12] + str((seed * 31 + i) % 97 if i % 5 == 0 else "") for i in range(n))


@pytest.fixture
def folder(spark, tmp_path):
    item = "benchmark words in a certain order that nobody else would write down here today"
    near = sentence(1, 200)
    secret = f"{sentence(5)} token = '{'0123456789abcdef' * 2}' end"
    rows = [(1, near), (2, near), (3, near + " tail"), (4, f"{sentence(3)} {item} {sentence(4)}"), (5, secret), (6, sentence(9)), (7, None), (8, ""), (9, "123 !!"), (None, sentence(11)), (6, sentence(9))]
    docs = [(d, t, "en" if i % 2 else None, "s", None if t is None else len(t), 1) for i, (d, t) in enumerate(rows)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, h int").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        kept[name] = sorted((r["doc_id"] for r in docs.collect()), key=str)
        if name == "secrets":
            text = {r["doc_id"]: r for r in docs.collect()}
            assert MASK in text[5]["text"] and text[5]["n_chars"] == len(text[5]["text"]) and MASK not in text[6]["text"]
    assert kept["language"] == sorted([1, 2, 3, 4, 5, 6, 6, None], key=str)
    assert kept["near_duplicates"] == [1, 4, 5, 6, 6, None]
    assert kept["decontaminate"] == kept["secrets"] == kept["tokens"] == [1, 5, 6, 6, None]
    assert sorted((r["doc_id"] for r in pipeline.run(spark, folder).collect()), key=str) == [1, 5, 6, 6, None]


def test_empty_tables(spark, folder, tmp_path):
    empty = str(tmp_path / "empty")
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert pipeline.run(spark, empty).count() == 0


def test_tokens_run_in_one_worker_a_task(spark, folder, capsys):
    """Two Python steps in one stage are two workers a task, each with the vocabulary: 4 instead of 2 an executor."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = pipeline.tokens(spark, docs, folder)
    capsys.readouterr()
    out.explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1
    path = pipeline.vocabulary_path()
    apart = pipeline.bpe.decode(pipeline.bpe.encode(docs, path), path)
    rows = lambda df: sorted(map(tuple, df.select("doc_id", "ids", "decoded").collect()), key=str)
    assert rows(pipeline.bpe.round_trip(docs, path)) == rows(apart)
    assert out.count() == docs.count()
