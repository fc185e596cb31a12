"""Cleaning, sources, sinks, streaming, geography and validation on small frames."""

import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions import fixed, impact, text
from tidemark.operators import damage, geography, naming, population, validation
from tidemark.operators import inventory as inv
from tidemark.plans import impact as plan
from tidemark.sinks import writers
from tidemark.sources import inventory as src
from tidemark.sources import tables
from tidemark.streaming import features

LABELS = ["D", "C", "B", "A"]


def buildings(spark, rows):
    return spark.createDataFrame(
        rows,
        "bid string, occtype string, val_struct double, sqft double, num_story double, found_type string, found_ht double, "
        "val_cont double, longitude double, latitude double, cbfips string",
    )


ROWS = [
    ("a", "RES1-X", 100.0, 10.0, 1.0, "S", 1.0, None, -81.0, 27.0, "120010000011001"),
    ("a", "RES1-X", 300.0, 10.0, 1.0, "S", 1.0, 7.0, -70.0, 27.0, "120010000011001"),
    ("b", "COM1", None, 10.0, None, None, 1.0, None, -81.0, 27.0, None),
    (None, "COM1", 1.0, 10.0, 1.0, "B", 1.0, None, -81.0, 27.0, None),
]


def test_policies_and_filter_before_dedup(spark):
    df = buildings(spark, ROWS)
    box = (-82.0, 26.0, -80.0, 28.0)
    strict = inv.engine_input(df, box).collect()
    # the dearer row of "a" lies outside the box, so the cheaper one wins
    assert [(r.FltyId, r.Cost, r.ContentCost) for r in strict] == [("a", 100.0, 0.0)]
    fill = {r.FltyId: r for r in inv.engine_input(df, box, "fill").collect()}
    assert set(fill) == {"a", "b"} and (fill["b"].Cost, fill["b"].NumStories, fill["b"].FoundationType) == (0.0, 1.0, 7)
    assert inv.dedup_inventory(df).where("bid = 'a'").first().val_struct == 300.0
    once = inv.dedup_inventory(df)
    assert inv.dedup_inventory(once).count() == once.count()
    with pytest.raises(ValueError):
        inv.engine_input(df, None, "other")


def test_hot_id_is_cut_before_the_shuffle(spark):
    plan_text = inv.engine_input(buildings(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert plan_text.count("WindowGroupLimit") == 2


def test_schema_checks(spark):
    df = buildings(spark, ROWS)
    assert inv.check_schema(df, ["bid", "state"], "report") == ["state"]
    with pytest.raises(ValueError, match="state"):
        inv.check_schema(df, ["state"])
    full = inv.conform_schema(df.withColumnRenamed("bid", "BID"))
    assert full.columns == schema.INVENTORY.names and full.schema["num_story"].dataType.typeName() == "long"
    assert full.where("processed_at IS NULL").isEmpty() and full.first().x == -81.0


def test_field_map_errors(spark):
    df = inv.engine_input(buildings(spark, ROWS))
    with pytest.raises(ValueError, match="exactly"):
        inv.normalize_field_map(["a"])
    with pytest.raises(ValueError, match="not in the input"):
        inv.apply_field_map(df, {**plan.ENGINE_MAPPING, "Cost": "Price"})
    with pytest.raises(ValueError, match="not mapped"):
        inv.apply_field_map(df, {**plan.ENGINE_MAPPING, "Cost": ""})
    with pytest.raises(TypeError):
        inv.normalize_field_map("Cost")


def test_zero_fill_never_truncates(spark):
    df = spark.createDataFrame([("12-34",), ("12345678901234567",), (None,), ("",)], "f string")
    got = [r[0] for r in df.select(text.block_fips(F.col("f"))).collect()]
    assert got == ["0" * 11 + "1234", "12345678901234567", None, "0" * 15]
    assert df.select(text.block_fips(F.col("f"), "zeros")).collect()[2][0] == "0" * 15


def feature(**change):
    body = {"type": "Feature", "geometry": {"type": "Point", "coordinates": [-81.5, 27.5]}, "properties": {"bid": "x", "cbfips": "010010201001000", "sqft": 9.5}}
    return json.dumps({**body, **change})


def test_feature_lines(spark, tmp_path):
    good = tmp_path / "good.txt"
    good.write_text(feature() + "\n\n  \n" + feature(geometry={"type": "Polygon", "coordinates": []}) + "\n")
    rows = src.read_feature_lines(spark, str(good)).orderBy(F.col("longitude").desc_nulls_last()).collect()
    assert [(r.bid, r.longitude, r.latitude) for r in rows] == [("x", -81.5, 27.5), ("x", None, None)]
    assert rows[0].cbfips == "010010201001000"
    other = tmp_path / "other.txt"
    other.write_text(feature() + "\n" + json.dumps({"type": "Thing"}) + "\n[1]\n")
    assert src.read_feature_lines(spark, str(other), "skip_non_feature").count() == 1
    with pytest.raises(Exception, match="not a GeoJSON feature"):
        src.read_feature_lines(spark, str(other)).collect()
    for mode in ("fail", "skip_non_feature"):
        broken = tmp_path / f"{mode}.txt"
        broken.write_text(feature() + '\n{"type": "Feature", "geom\n')
        with pytest.raises(Exception, match="invalid JSON"):
            src.read_feature_lines(spark, str(broken), mode).collect()
    empty = tmp_path / "empty.txt"
    empty.write_text("\n \n")
    with pytest.raises(ValueError, match="empty"):
        src.read_feature_lines(spark, str(empty))


def test_feature_collection_document(spark, tmp_path):
    doc = tmp_path / "all.geojson"
    doc.write_text(json.dumps({"type": "FeatureCollection", "features": [json.loads(feature()), json.loads(feature())]}, indent=2))
    assert src.read_feature_collection(spark, str(doc)).select("bid", "latitude").distinct().collect() == [("x", 27.5)]


def test_feature_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    props = {"bid": "x", "occtype": "RES1-A", "val_struct": 5.0, "sqft": 9.5, "num_story": 2, "found_type": "B", "found_ht": 1.0}
    (tmp_path / "in" / "f.txt").write_text(feature(properties=props) + "\n" + feature() + "\n")
    rows = features.engine_stream(features.read_feature_stream(spark, str(tmp_path / "in")))
    features.write_feature_stream(rows, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r.FltyId, r.Occ, r.FoundationType) for r in got] == [("x", "RES1", 4)]


def test_writers_refuse_to_overwrite(spark, tmp_path):
    df = inv.engine_input(buildings(spark, ROWS))
    path = str(tmp_path / "engine")
    assert writers.write_engine_input(df, path) == 1
    with pytest.raises(AnalysisException):
        writers.write_engine_input(df, path)
    assert writers.write_engine_input(df, path, overwrite=True) == 1
    assert writers.result_name("nsw.csv", "IAN_adv3.tif") == "nsw_IAN_adv3"
    with pytest.raises(ValueError):
        writers.write_geo_output(df, path + "x", "xlsx")


def test_csv_and_parquet_give_the_same_results(spark, tmp_path, lookups):
    df = inv.engine_input(buildings(spark, [(f"b{i}", "RES1-X", 100.25 * i, 33.3 * i, 1.0 + i % 3, "B", 0.5, None, -81.0, 27.0, None) for i in range(40)]))
    writers.write_engine_input(df, str(tmp_path / "e.csv"))
    df.write.parquet(str(tmp_path / "e.parquet"))
    out = []
    for kind in ("csv", "parquet"):
        rows = inv.apply_field_map(src.read_inventory_auto(spark, str(tmp_path / f"e.{kind}")), plan.ENGINE_MAPPING)
        wet = rows.withColumns({"raster_id": F.lit("g"), "depth_grid": F.lit(4.25)})
        out.append(damage.assess(wet, ["FltyId"], plan.ENGINE_MAPPING, "CoastalA", lookups).orderBy("FltyId").collect())
    assert out[0] == out[1] and len(out[0]) == 40


def test_report_and_manifest_files(spark, tmp_path):
    rows = [("a", 1.0, 2.0, "Texas", "V", "RES1", "0"), ("b", 1.0, 2.0, "Texas", "V", "RES1", "oops"), ("c", 1.0, 2.0, "Ohio", "V", "COM1", "5.5")]
    df = spark.createDataFrame(rows, "FltyId string, Latitude double, Longitude double, state string, flc string, Occ string, BldgDmgPct string")
    writers.write_validation_report(df, str(tmp_path / "report"))
    report = json.loads(spark.read.text(str(tmp_path / "report")).first()[0])
    assert report["passed"] and report["summary"]["zero_loss_pct"] == 66.67 and report["summary"]["damage_by_state"] == {"Ohio": 5.5, "Texas": 0.0}
    assert report["summary"]["rows_by_occ_top10"] == {"RES1": 2, "COM1": 1}
    nothing = json.loads(validation.validation_report(df.where("false").drop("flc")).first()[0])
    assert not nothing["passed"] and len(nothing["issues"]) == 2
    warned = validation.validation_checks(validation.prediction_summary(df.withColumn("BldgDmgPct", F.lit("0")))).first()
    assert warned.passed and warned.issues[0].startswith("WARN: 100.0%")
    writers.write_manifest(writers.manifest(df, df.where("state = 'Ohio'")), str(tmp_path / "m"), engine="spark")
    lines = {d["state"]: d for d in map(lambda r: json.loads(r[0]), spark.read.text(str(tmp_path / "m")).collect())}
    assert lines["Texas"]["output_rows"] == 0 and lines["Ohio"]["engine"] == "spark"


def test_event_yaml(spark, tmp_path):
    path = tmp_path / "events.yaml"
    path.write_text('events:\n  ian_2022:\n    states: [Florida, South_Carolina]\n    raster_pattern: "IAN_2022"\n')
    events = tables.read_event_states(spark, str(path))
    assert naming.explode_event_states(events).count() == 2
    rasters = spark.createDataFrame([("Ian_2022_adv31_e10_x.tif",), ("IDA_2021_adv1_e10_x.tif",)], "raster_id string")
    assert [r.event for r in naming.rasters_of_events(events, rasters).collect()] == ["ian_2022"]


@pytest.mark.parametrize(
    "given,year,want",
    [("al022024", 2020, "AL022024"), ("AL2", 2024, "AL022024"), ("AL0224", 2020, "AL022024"), ("AL224", 2020, "AL022024"), ("beryl", 2024, "BERYL2024")],
)
def test_storm_id(spark, given, year, want):
    df = spark.createDataFrame([(given, year)], "s string, y int")
    assert df.select(text.storm_id(F.col("s"), F.col("y"))).first()[0] == want


def test_archives(spark):
    req = spark.createDataFrame([("AL02", 29, 2024)], "storm_id string, advisory int, year int")
    cands = naming.candidate_archives(req)
    assert [r.name for r in cands.orderBy("rank").collect()] == [
        "AL0224_29_tidalmask.zip", "AL0224_029_tidalmask.zip", "AL022024_29_tidalmask.zip", "AL022024_029_tidalmask.zip",
        "AL0224_tidalmask_latest.zip", "AL022024_tidalmask_latest.zip",
    ]
    links = spark.createDataFrame([("AL022024_tidalmask_latest.zip", "u1")], "name string, url string")
    assert [r.url for r in naming.resolve_archives(cands, links, ["storm_id"]).collect()] == ["u1"]
    both = links.union(spark.createDataFrame([("AL0224_029_tidalmask.zip", "u2")], links.schema))
    assert [r.url for r in naming.resolve_archives(cands, both, ["storm_id"]).collect()] == ["u2"]


def test_classification_edges(spark):
    df = spark.createDataFrame([(12.0, 0.0), (12.5, 0.0), (9.0, 0.0), (4.0, 99.0), (3.9, 35.5), (0.0, 15.1), (0.0, 0.1), (0.0, 0.0)], "d double, p double")
    got = [r[0] for r in df.select(impact.intensity_zone(F.col("d"), F.col("p"))).collect()]
    assert got == ["MEDIUM", "HIGH", "MEDIUM", "LOW", "HIGH", "MEDIUM", "LOW", "NONE"]
    df = spark.createDataFrame([(9.0,), (8.9,), (6.0,), (3.0,), (1.0,), (0.9,), (None,)], "d double")
    assert [r[0] for r in df.select(impact.depth_category(F.col("d"), LABELS)).collect()] == ["D", "C", "C", "B", "A", "None", "None"]
    df = spark.createDataFrame([(10.9,), (11.0,), (35.0,)], "p double")
    assert [r[0] for r in df.select(impact.tract_severity(F.col("p"))).collect()] == ["LOW", "MEDIUM", "HIGH"]
    df = spark.createDataFrame([(0.39,), (0.4,), (0.8,), (1.0,)], "p double")
    assert [r[0] for r in df.select(impact.svi_rate(F.col("p"))).collect()] == [0.0, 0.025, 0.05, 0.05]
    df = spark.createDataFrame([(250.0,), (50.0,)], "n double")
    assert [r[0] for r in df.select(impact.mass_care(F.col("n"), "LOW", fixed.SHELTER_RATE)).collect()] == [2, 0]


def test_fill_names_crosses_counties_only_on_request(spark):
    rows = [("01", "01001", "01001000001", None), ("01", "01001", "01001000002", "A"), ("01", "01001", "01001000003", None),
            ("01", "01003", "01003000001", None), ("02", "02001", "02001000001", "B"), ("02", "02003", "02003000001", None)]
    df = spark.createDataFrame([(*r, r[3]) for r in rows], "State_FIPS string, County_FIPS string, FIPS string, ST_ABBR string, COUNTY string")
    local = [r.COUNTY for r in geography.fill_names(df).orderBy("FIPS").collect()]
    assert local == ["A", "A", "A", None, "B", None]
    whole = [r.COUNTY for r in geography.fill_names(df, backward="global").orderBy("FIPS").collect()]
    assert whole == ["A", "A", "A", "B", "B", None]


def test_run_damage_keeps_outside_rows_on_request(spark, lookups):
    from tests.test_spatial import PLAIN

    m = spark.createDataFrame([PLAIN], schema.RASTER_META)
    px = spark.createDataFrame([("grid", 0, 0, 5.0)], schema.RASTER_PIXELS)
    df = inv.engine_input(buildings(spark, [("in", "RES1", 9.9, 10.0, 1.0, "S", 1.0, None, -81.95, 27.95, None), ("out", "RES1", 9.9, 10.0, 1.0, "S", 1.0, None, -70.0, 27.95, None)]))
    clipped = damage.run_damage(df, plan.ENGINE_MAPPING, "CoastalA", m, px, lookups)
    assert [(r.FltyId, r.Depth_Grid, r.GridName, r.flc) for r in clipped.collect()] == [("in", 5.0, "grid", "CoastalA")]
    every = damage.run_damage(df, plan.ENGINE_MAPPING, "CoastalA", m, px, lookups, rasters="grid", clip=False)
    assert {r.FltyId: r.status for r in every.collect()} == {"in": "ok", "out": "not_exposed"}
    with pytest.raises(ValueError):
        damage.run_damage(df, plan.ENGINE_MAPPING, "CoastalA", m, px, lookups, clip=False)


def test_per_raster_winner_equals_separate_runs(spark):
    """A building id repeated at places under different rasters keeps one row per raster."""
    from tests.test_spatial import PLAIN

    east = ("east", -81.0, 28.0, 0.1, 0.1, 10, 10, None, False, None, False)
    m = spark.createDataFrame([PLAIN, east], schema.RASTER_META)
    rows = [("a", "RES1", float(v), 10.0, 1.0, "S", 1.0, None, x, 27.5, None) for v, x in ((5, -81.5), (9, -80.5), (7, -81.0), (6, -81.0))]
    got = {(r.raster_id, r.FltyId): r.Cost for r in plan.clipped_inventory(buildings(spark, rows), m).collect()}
    assert got == {("grid", "a"): 7.0, ("east", "a"): 9.0}


def test_settings_overlay():
    p = plan.RunParams.of({"geography": "census tract", "building_types": {"RES2": "N"}})
    assert p.geography == "census tract" and p.building_types["RES2"] == "N" and p.building_types["RES1"] == "Y"


@pytest.mark.skipif(not os.environ.get("VALIDATION_CSV"), reason="needs the published validation table in VALIDATION_CSV")
def test_published_accuracy(spark):
    df = tables.read_validation_table(spark, os.environ["VALIDATION_CSV"])
    got = {r.event: r for r in validation.accuracy_metrics(df, "shelter_pop", "total_shelter_est").collect()}
    want = {None: (55, 1550.9, 908.8, -17.598), "BERYL_2024": (4, 649.2, 583.0, -28.411), "FLORENCE_2018": (9, 865.9, 645.8, -1.081),
            "HELENE_2024": (16, 2419.1, 1361.5, -5821.228), "IDA_2021": (17, 962.4, 642.1, -31.293), "MILTON_2024": (9, 1268.6, 1015.6, -25.815)}
    for event, (n, rmse, mae, r2) in want.items():
        r = got[event]
        assert (r.n, round(r.rmse, 1), round(r.mae, 1), round(r.r2, 3)) == (n, rmse, mae, r2)
    keys = ["event", "county_fips5"]
    needs = [c for c in df.columns if c.startswith("hh_")] + ["total_shelter_est"]
    want = df.select(*keys, F.col("shelter_pop").alias("want_target"), *[F.col(c).alias(f"want_{c}") for c in needs])
    again = population.ground_truth_target(population.mass_care_demand(df.drop("shelter_pop", *needs))).join(want, keys)
    assert again.count() == 55
    for c in needs:
        assert again.where(f"{c} <> want_{c}").isEmpty()
    assert again.where("shelter_pop <> want_target").isEmpty()
