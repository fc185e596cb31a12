"""Feature text that queries store on their way is packed, and cut into files that tasks share."""

import glob
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from registry import base as b
from registry import catalog, spatial_queries
from tidemark.sinks import writers
from tidemark.sources import inventory as src

SHAPE = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string"


def lineitem(spark, folder, n=4000):
    """Rows of a few documents, some keys twice, one row without key."""
    rows = [(3 * (i // 2) + 1, 37 * i, 11 * i, i % 7 + 1, float(i % 50), i / 4, "ANR"[i % 3]) for i in range(n)]
    spark.createDataFrame([*rows, *rows[:5], (None, 1, 1, 1, 1.0, 1.0, "A")], SHAPE).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def text_files(folder):
    return [f for f in glob.glob(f"{folder}/**/part-*", recursive=True) if ".txt" in os.path.basename(f)]


def test_lines_are_packed_and_cut(spark, tmp_path):
    lines = spark.range(1000, numPartitions=2).selectExpr("concat('line ', id) AS value")
    writers.write_lines(lines, str(tmp_path / "a"), file_lines=100)
    files = text_files(tmp_path)
    assert len(files) == 10 and all(len(gzip.open(f).read().splitlines()) == 100 for f in files)
    assert spark.read.text(str(tmp_path / "a")).distinct().count() == 1000


PACKED = ["src04_feature_lines", "str01_feature_stream", "src05_feature_collection", "snk08_manifest"]


@pytest.mark.parametrize("name", PACKED)
def test_stored_feature_text_is_small(spark, tmp_path, monkeypatch, name):
    sf = lineitem(spark, tmp_path)
    monkeypatch.setattr(spatial_queries, "scratch_dir", lambda s: str(tmp_path / "scratch"))
    catalog.QUERIES[name](spark, sf).collect()
    plain = src.feature_lines(b.bldg(spark, sf)).agg(F.sum(F.length("value"))).first()[0]
    files = text_files(tmp_path / "scratch")
    assert files and sum(map(os.path.getsize, files)) < plain / 4


def test_documents_are_whole_json(spark, tmp_path, monkeypatch):
    """Every row is a feature of the document of its key; stored rows move, not their text."""
    sf = lineitem(spark, tmp_path)
    monkeypatch.setattr(spatial_queries, "scratch_dir", lambda s: str(tmp_path / "scratch"))
    out = catalog.QUERIES["src05_feature_collection"](spark, sf)
    assert out.agg(F.sum("n")).first()[0] == 4006
    docs = {}
    for f in text_files(tmp_path / "scratch"):
        key = f.split("doc=")[1].split("/")[0]
        doc = json.loads(gzip.open(f).read())
        assert doc["type"] == "FeatureCollection" and key not in docs
        docs[key] = [x["properties"].get("fd_id") for x in doc["features"]]
    assert {k: len(v) for k, v in docs.items()} == {"0": 2735, "1": 1270, "__HIVE_DEFAULT_PARTITION__": 1}
    assert all(str(i // 4096) == k for k, v in docs.items() for i in v if i is not None)
