"""What grows with the inventory: moved rows, generated methods, stored text."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.operators import damage, extents, spatial
from tidemark.plans import impact as plan
from tidemark.sinks import writers

PLACES = [(f"b{i}", "RES1", 100.0 + i, 10.0, 1.0, "S", 1.0, 25.0 + 0.01 * i, -80.0 + 0.01 * i, None, "120860001001001", "Florida") for i in range(40)]
NAMES = "bid string, occtype string, val_struct double, sqft double, num_story double, found_type string, found_ht double, latitude double, longitude double, val_cont double, cbfips string, state string"


def storm(spark, tmp_path, rows=PLACES, size=40):
    """Stored buildings, two rasters over them, one of them projected, and their pixels and strays."""
    spark.createDataFrame([*rows, rows[0]], NAMES).write.parquet(str(tmp_path / "bldg"))
    metas = [("A_2024_adv1_e10.tif", -80.1, 25.5, 0.02, 0.02, size, size, -9999.0, False, None, False), ("B_2024_adv2_e10.tif", 5.9e5, 2.85e6, 2000.0, 2000.0, size, size, -9999.0, True, 17, False)]
    spots = [(m[0], r, c, float(r + c) / 4) for m in metas for r in range(-1, size + 1) for c in range(size)] + [("C_2024_adv1_e10.tif", 1, 1, 9.0)]
    spark.createDataFrame(metas, schema.RASTER_META).write.parquet(str(tmp_path / "meta"))
    spark.createDataFrame(spots, "raster_id string, r int, c int, value double").write.parquet(str(tmp_path / "pixels"))
    return [spark.read.parquet(str(tmp_path / n)) for n in ("bldg", "meta", "pixels")]


@pytest.fixture
def unmeasured(spark):
    """Sizes as the planner sees them in a large run: no table is known to be small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def physical(df):
    return df._jdf.queryExecution().executedPlan()


def test_counted_metadata_moves_no_building(spark, lookups, tmp_path, unmeasured):
    """Extents, metadata and pixels of small grids meet the buildings where they are."""
    bldg, meta, pixels = storm(spark, tmp_path)
    out = plan.damage_by_raster(bldg, meta, pixels, lookups)
    joins = re.findall(r"(SortMergeJoin|BroadcastHashJoin) \[(\w+)", physical(out).toString())
    assert {k for k, c in joins if c in ("_cx", "_cell", "raster_id")} == {"BroadcastHashJoin"}
    got = {(r.FltyId, r.GridName, r.Depth_Grid) for r in out.collect()}
    assert {g for _, g, _ in got} == {"A_2024_adv1_e10.tif", "B_2024_adv2_e10.tif"} and any(d > 0 for *_, d in got)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    known = spatial.raster_bounds(meta)
    rows = spatial.with_meta(plan.clipped_inventory(bldg, meta), meta)
    plain = spatial.sample_depth(spatial.grid_position(rows, "Longitude", "Latitude"), pixels)
    assert {(r.FltyId, r.raster_id, r.depth_grid) for r in plain.collect()} == got
    assert extents.survey(known).rasters == 2


def test_survey_counts(spark):
    boxes = [("a", 0.0, 0.0, 2.5, 1.0), ("b", -0.5, -0.5, 0.5, 0.5), ("zero", 0.0, 0.0, 0.0, 0.0)]
    bounds = spark.createDataFrame(boxes, "raster_id string, xmin double, ymin double, xmax double, ymax double").repartition(3)
    got = extents.survey(bounds, 32)
    assert (got.rasters, got.cells) == (3, 6 + 4 + 1) and sorted(got.boxes) == sorted(b[1:] for b in boxes) and got.places == float("inf")
    sized = extents.survey(bounds.withColumns({"n_rows": F.lit(4), "n_cols": F.lit(5)}), 1)
    assert sized.places == 60 and sized.boxes == [(-0.5, -0.5, 2.5, 1.0)]
    with pytest.raises(ValueError):
        extents.survey(bounds.withColumn("xmin", F.when(F.col("raster_id") != "a", F.col("xmin"))))


def largest_method(spark, df):
    text = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$").codegenString(physical(df))
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text)))


def test_loops_of_a_run_are_short_enough_to_be_compiled(spark, lookups, tmp_path, unmeasured):
    bldg, meta, pixels = storm(spark, tmp_path)
    out = plan.run_population(plan.damage_by_raster(bldg, meta, pixels, lookups), ["RES1"])
    assert largest_method(spark, out) < 8000
    assert out.count() >= 1


def test_pushed_filters_pass_a_fence(spark, tmp_path):
    from tidemark.operators.joins import fenced

    path = str(tmp_path / "rows")
    spark.createDataFrame([("a", 1.0, None), ("b", 2.0, 3.0), (None, None, 4.0)], "k string, x double, y double").write.parquet(path)
    rows = fenced(spark.read.parquet(path), "y")
    assert [tuple(r) for r in rows.orderBy("y").collect()] == [("a", 1.0, None), ("b", 2.0, 3.0), (None, None, 4.0)]
    assert "GreaterThan(x,1.0)" in physical(rows.where("x > 1")).toString()


def test_run_damage_works_out_a_cell_once(spark, lookups, tmp_path, unmeasured):
    """The cell of a row is not worked out again in a filter below the join, and the loops stay short."""
    bldg, meta, pixels = storm(spark, tmp_path)
    engine = plan.clipped_inventory(bldg, meta).drop("raster_id")
    out = damage.run_damage(engine, plan.ENGINE_MAPPING, "CoastalA", meta, pixels, lookups)
    assert not re.search(r"Filter [^\n]*-9223372036854775808", physical(out).toString())
    sums = [F.sum(F.col(c).cast("decimal(24,6)")).alias(c) for c in ("Depth_Grid", "BldgLossUSD", "ContentLossUSD", "InventoryLossUSD", "Debris_Tot")]
    assert largest_method(spark, out.groupBy("GridName", "Occ").agg(*sums)) < 8000


def test_predictions_are_written_where_they_are(spark, tmp_path):
    """One file for an event from each task that has it, also of more events than a task holds open."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    rows = spark.range(0, 4000, numPartitions=2).selectExpr("concat('b', id) AS FltyId", "concat('E', id % 40) AS event", "CAST(id % 2 AS INT) AS adv", "id / 2 AS BldgLossUSD")
    rows = rows.union(spark.range(1, numPartitions=1).selectExpr("'x'", "NULL", "3", "0.5D"))
    writers.write_predictions(rows, str(tmp_path / "out"))
    files = [f for f in (tmp_path / "out").rglob("part-*")]
    assert len(files) == 2 * 40 + 1 and spark.conf.get(name) == before
    read = spark.read.parquet(str(tmp_path / "out")).select(*rows.columns)
    assert sorted(map(str, read.collect())) == sorted(map(str, rows.collect()))
