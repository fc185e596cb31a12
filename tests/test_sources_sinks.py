"""Split documents, staged replacement, manifests with file sizes, runs of one event, stored sketches."""

import json
import os

import pytest
from pyspark.sql import functions as F

from registry import base as b
from registry.cleaning_queries import EVENT_ROWS
from tidemark.operators import geography
from tidemark.operators import inventory as inv
from tidemark.plans import impact as plan
from tidemark.sinks import publish, writers
from tidemark.sources import inventory as src
from tidemark.sources import tables


# --- feature collections -------------------------------------------------------------
def feature(i, name="a"):
    return {"type": "Feature", "properties": {"bid": f"b{i}", "occtype": name, "val_struct": i + 0.5}, "geometry": {"type": "Point", "coordinates": [i / 100, -i / 100]}}


def document(features, **kw):
    return json.dumps({"type": "FeatureCollection", "name": "x", "features": features, "crs": {"type": "name", "properties": {"a": [1]}}}, **kw)


def rows(df):
    return sorted((r.bid, r.occtype, r.val_struct, r.longitude, r.latitude) for r in df.collect())


@pytest.mark.parametrize("style", [{}, {"indent": 2}, {"separators": (",", ":")}])
def test_split_documents_equal_whole_ones(spark, tmp_path, style):
    odd = ['quoted "Feature" inside', "{\"type\":", "}]}", "Feature", "é\n", "]"]
    (tmp_path / "a.geojson").write_text(document([feature(i, odd[i % len(odd)] if i % len(odd) != 3 else "Features") for i in range(50)], **style))
    (tmp_path / "b.geojson").write_text("﻿" + document([feature(99)], **style) + "\n")
    (tmp_path / "c.geojson").write_text(document([], **style))
    split = src.read_feature_collection(spark, str(tmp_path))
    assert split.columns == src.read_feature_collection(spark, str(tmp_path), whole=True).columns
    (tmp_path / "b.geojson").write_text(document([feature(99)], **style))
    assert rows(split) == rows(src.read_feature_collection(spark, str(tmp_path), whole=True)) and split.count() == 51


def test_one_document_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "large.geojson"
    with path.open("w") as f:
        f.write('{"type":"FeatureCollection","features":[')
        for i in range(60_000):
            f.write(("," if i else "") + json.dumps(feature(i)))
        f.write("]}")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 << 10))
    try:
        df = src.read_feature_collection(spark, str(path))
        assert df.rdd.getNumPartitions() > 20
        got = df.agg(F.count("*"), F.countDistinct("bid"), F.sum("val_struct")).first()
        assert tuple(got) == (60_000, 60_000, sum(i + 0.5 for i in range(60_000)))
        used = df.select(F.spark_partition_id().alias("p")).distinct().count()
        assert used > 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize(
    "body",
    [
        '{"type":"FeatureCollection","features":[{"properties":{"bid":"a"},"type":"Feature","geometry":null}]}',
        '{"type":"FeatureCollection","features":[{"properties":{"bid":"a"},"geometry":null,"type":"Feature"},{"properties":{"bid":"b"},"geometry":null,"type":"Feature"}]}',
        '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"bid":"Feature"},"geometry":null}]}',
        '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"bid":"a",,"geometry":null}]}',
        '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"bid":"a"}',
    ],
)
def test_documents_that_cannot_be_split_fail(spark, tmp_path, body):
    (tmp_path / "a.geojson").write_text(body)
    with pytest.raises(Exception):
        src.read_feature_collection(spark, str(tmp_path)).collect()


# --- replacement -----------------------------------------------------------------------
def table(spark, n, name="Ohio"):
    return spark.range(n).select(F.col("id").cast("string").alias("bid"), F.lit(name).alias("state"), F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"))


def test_failed_replacement_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_inventory(table(spark, 5), path)
    broken = table(spark, 500).withColumn("bid", F.when(F.col("bid") == "499", F.raise_error(F.lit("lost"))).otherwise(F.col("bid")))
    with pytest.raises(Exception, match="lost"):
        writers.write_inventory(broken, path, overwrite=True)
    assert spark.read.parquet(path).count() == 5 and os.listdir(tmp_path) == ["t"]
    writers.write_inventory(table(spark, 7, "Iowa"), path, overwrite=True)
    assert [tuple(r) for r in spark.read.parquet(path).groupBy("state").count().collect()] == [("Iowa", 7)]
    assert os.listdir(tmp_path) == ["t"]


def test_table_read_while_it_is_replaced(spark, tmp_path):
    """A table can be replaced by rows that are read from it."""
    path = str(tmp_path / "t")
    table(spark, 5).write.parquet(path)
    doubled = spark.read.parquet(path).union(spark.read.parquet(path))
    publish.publish(doubled, path, True, lambda writer, to: writer.parquet(to))
    assert spark.read.parquet(path).count() == 10


def test_second_rename_that_fails_is_undone(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    table(spark, 5).write.parquet(path)
    real, calls = publish._rename, []

    def fails_once(fs, old, new):
        calls.append(new)
        if len(calls) == 2:
            raise OSError("no")
        real(fs, old, new)

    monkeypatch.setattr(publish, "_rename", fails_once)
    with pytest.raises(OSError):
        publish.publish(table(spark, 1), path, True, lambda writer, to: writer.parquet(to))
    assert spark.read.parquet(path).count() == 5


def test_restore_after_a_lost_driver(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, 5).write.parquet(path)
    assert not publish.restore(spark, path)
    os.rename(path, str(tmp_path / f"_t{publish.REPLACED}abc"))
    assert publish.restore(spark, path) and spark.read.parquet(path).count() == 5
    assert not publish.restore(spark, str(tmp_path / "none"))


# --- manifest ---------------------------------------------------------------------------
def test_manifest_measures_files(spark, tmp_path):
    raw, stored = str(tmp_path / "raw"), str(tmp_path / "stored")
    rows = table(spark, 40).unionByName(table(spark, 10, "Texas")).unionByName(table(spark, 3, "Atlantis"))
    rows.repartition(3).write.partitionBy("state").json(raw)
    writers.write_inventory(rows.where("state <> 'Texas'"), stored)
    out = {r.state: r for r in writers.state_manifest(spark.read.json(raw), spark.read.parquet(stored)).collect()}

    def size(root, state):
        folder = os.path.join(root, f"state={state}")
        names = [n for n in os.listdir(folder) if n.startswith("part-")] if os.path.isdir(folder) else []
        return len(names), sum(os.path.getsize(os.path.join(folder, n)) for n in names)

    for state in ("Ohio", "Texas", "Atlantis"):
        r = out[state]
        assert (r.raw_files, r.raw_bytes) == size(raw, state) and (r.output_files, r.output_bytes) == size(stored, state)
    assert (out["Ohio"].abbr, out["Ohio"].fips, out["Ohio"].feature_count, out["Ohio"].output_rows) == ("OH", "39", 40, 40)
    assert (out["Texas"].abbr, out["Texas"].output_rows, out["Atlantis"].abbr) == ("TX", 0, None)
    files = writers.stored_files(spark.read.parquet(stored)).collect()
    assert sum(f.n_rows for f in files) == 43 and all(f.bytes > 0 for f in files)


# --- runs of one event ----------------------------------------------------------------
def test_event_run_prunes_states_at_run_time(spark, sf, tmp_path):
    path = str(tmp_path / "inventory")
    writers.write_inventory(b.bldg(spark, sf), path)
    (tmp_path / "events.yaml").write_text("events:\n" + "".join(f"  {e}:\n    states: [{', '.join(s.replace(' ', '_') for s in states)}]\n    raster_pattern: \"{p}\"\n" for e, states, p in EVENT_ROWS))
    events = tables.read_event_states(spark, str(tmp_path / "events.yaml"))
    params = plan.RunParams.of({"event": "storm_p"})
    with pytest.raises(ValueError):
        plan.damage_by_raster(spark.read.parquet(path), b.meta(spark, sf), b.pixels(spark, sf), b.lookups(spark), params)
    out = plan.damage_by_raster(spark.read.parquet(path), b.meta(spark, sf), b.pixels(spark, sf), b.lookups(spark), params, events)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    got = out.select("state", "GridName").distinct()
    assert {r.state for r in got.collect()} == {"South Carolina", "Georgia"} and {r.GridName[:6] for r in got.collect()} == {"STORMP"}
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text
    near = plan.clipped_inventory(*plan.of_event(spark.read.parquet(path), b.meta(spark, sf), events, "storm_p"))
    near.collect()
    read = scan_of(near._jdf.queryExecution().executedPlan(), "state")
    assert read == 2  # of the four stored states
    # the same as a run over these states named by hand
    by_hand = plan.clipped_inventory(spark.read.parquet(path), b.meta(spark, sf).where("raster_id LIKE 'STORMP%'"), states=["South Carolina", "Georgia"])
    assert sorted(map(str, near.collect())) == sorted(map(str, by_hand.collect()))


def scan_of(plan_node, partition):
    """Partitions read by the scan of the partitioned table in an executed plan."""
    found, nodes = [], [plan_node]
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            nodes.append(node.plan())
        elif name.startswith("Scan parquet") and node.metrics().contains("numPartitions"):
            found.append(node.metrics().apply("numPartitions").value())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return max(found)


# --- sketches ---------------------------------------------------------------------------
def test_stored_sketches_merge(spark, tmp_path):
    rows = spark.range(60_000).selectExpr("concat('E', id % 3) AS event", "CAST(id % 40 AS STRING) AS county_geoid", "CAST(id % 900 AS STRING) AS tract_geoid", "CAST(id DIV 2 AS STRING) AS fltyid")
    path = str(tmp_path / "s")
    for k in range(3):  # each run adds its own
        geography.geography_sketches(rows.where(f"event = 'E{k}'"), ["event"]).write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    total = geography.count_sketches(stored).first()
    assert (total.n_county_geoid, total.n_tract_geoid) == (40, 900) or abs(total.n_tract_geoid - 900) < 900 * 4 * geography.sketch_error()
    assert abs(total.n_fltyid - 30_000) < 30_000 * 4 * geography.sketch_error()
    one = geography.count_sketches(stored.where("event = 'E1'"), ["event"]).first()
    assert abs(one.n_fltyid - rows.where("event = 'E1'").select("fltyid").distinct().count()) < 20_000 * 4 * geography.sketch_error()
    assert geography.count_sketches(stored.where("false")).first().n_fltyid in (0, None)


def test_engine_rows_unchanged_by_policy_of_publish(spark, tmp_path):
    df = inv.engine_columns(b.bldg(spark, "/root/testdata/sf0.001").limit(3))
    assert writers.write_engine_input(df, str(tmp_path / "e")) == 3
    assert writers.write_engine_input(df, str(tmp_path / "e"), overwrite=True) == 3
