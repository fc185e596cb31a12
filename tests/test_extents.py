"""Packed extents, scan ranges for many scattered storms, and projected extents."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions import geo
from tidemark.operators import extents, spatial


def boxes_of(n, seed=1):
    rng = np.random.default_rng(seed)
    corner = np.stack([rng.uniform(-170, 160, n), rng.uniform(-80, 75, n)], axis=1)
    return np.concatenate([corner, corner + rng.uniform(0.1, 2, (n, 2))], axis=1)


def covered(box, by):
    return any(b[0] <= box[0] and b[1] <= box[1] and b[2] >= box[2] and b[3] >= box[3] for b in by)


def test_merging_prefers_the_least_added_area():
    near = [[0, 0, 1, 1], [0.5, 0, 1.5, 1], [50, 50, 51, 51], [51, 50, 52, 51], [-70, 10, -69, 11]]
    got = extents.merge_boxes(np.array(near), 3)
    assert sorted(map(tuple, got.tolist())) == [(-70, 10, -69, 11), (0, 0, 1.5, 1), (50, 50, 52, 51)]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 120), st.integers(1, 40), st.integers(0, 5))
def test_reduction_covers_every_box(n, most, seed):
    boxes = boxes_of(n, seed)
    got = extents.reduce_boxes([boxes[: n // 2], boxes[n // 2 :]], most)
    assert len(got) <= most and all(covered(b, got) for b in boxes)


def far_meta(spark, boxes):
    rows = [(f"r{i}", float(x0), float(y1), float(x1 - x0) / 8, float(y1 - y0) / 8, 8, 8, None, False, None, False) for i, (x0, y0, x1, y1) in enumerate(boxes)]
    return spark.createDataFrame(rows, schema.RASTER_META)


@pytest.mark.parametrize("n", [0, 1, 33, 34, 3000])
def test_any_number_of_extents(spark, n):
    boxes = boxes_of(n)
    bounds = spatial.raster_bounds(far_meta(spark, boxes)).repartition(5)
    packed = extents.packed_extents(bounds, 32)
    assert len(packed) == min(n, 32)
    exact = [(r.xmin, r.ymin, r.xmax, r.ymax) for r in bounds.collect()]
    assert all(covered(b, packed) for b in exact)
    rng = np.random.default_rng(9)
    places = [(f"b{i}", float(x), float(y)) for i, (x, y) in enumerate(zip(rng.uniform(-180, 180, 400), rng.uniform(-90, 90, 400)))]
    places += [(f"c{i}", float((b[0] + b[2]) / 2), float((b[1] + b[3]) / 2)) for i, b in enumerate(exact[:50])]
    df = spark.createDataFrame([*places, ("none", None, 1.0)], "id string, longitude double, latitude double")
    want = {(i, f"r{k}") for i, x, y in places for k, b in enumerate(boxes) if b[0] <= x <= b[2] and b[1] <= y <= b[3]}
    pairs = spatial.bbox_join(df, bounds).select("id", "raster_id")
    near = {(a, b) for a, b in want} ^ {(r.id, r.raster_id) for r in pairs.collect()}
    assert not near
    over = spatial.rasters_over(df, bounds, cell=20.0, in_row=7).select("id", F.explode("raster_ids").alias("raster_id"))
    assert {(r.id, r.raster_id) for r in over.collect()} == want and over.count() == len(want)


def test_scattered_storms_keep_separate_ranges(spark, tmp_path):
    """Row groups between the storms are not read, although there are more storms than ranges."""
    boxes = boxes_of(60)
    path = str(tmp_path / "rows")
    spark.range(20_000).select((F.col("id") % 360 - 180.0).alias("longitude"), (F.col("id") / 20_000 * 180 - 90).alias("latitude")).write.parquet(path)
    near = spatial.near_rasters(spark.read.parquet(path), spatial.raster_bounds(far_meta(spark, boxes)), most=12)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    scan = next(line for line in near._jdf.queryExecution().executedPlan().toString().splitlines() if "PushedFilters" in line)
    assert scan.split("PushedFilters")[1].count("GreaterThanOrEqual(latitude") == 12
    one = extents.packed_extents(spatial.raster_bounds(far_meta(spark, boxes)), 1)
    assert near.count() < 0.7 * spark.read.parquet(path).where(F.col("latitude").between(one[0][1], one[0][3])).count()


def test_whole_numbers_and_text_as_places(spark):
    bounds = spatial.raster_bounds(far_meta(spark, [(10.0, 10.0, 12.0, 12.0)]))
    whole = spark.createDataFrame([(11, 11), (50, 50)], "longitude int, latitude int")
    assert spatial.near_rasters(whole, bounds).count() == 1
    text = spark.createDataFrame([("11", "x"), ("50", "50")], "longitude string, latitude string")
    assert spatial.near_rasters(text, bounds).count() == 2


def test_projected_extents_hold_a_dense_trace(spark):
    """Edges bend between the samples: no place on them may leave the extent, and the margin stays small."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(40):
        zone, south = int(rng.integers(1, 61)), bool(rng.integers(0, 2))
        size = float(10 ** rng.uniform(2, 5.6))
        x0, north = rng.uniform(2e5, 8e5 - size / 2), rng.uniform(size, 8.5e6)
        rows.append((f"p{i}", float(x0), float(1e7 - north + size if south else north), size / 10, size / 10, 10, 10, None, True, zone, south))
    meta = spark.createDataFrame(rows, schema.RASTER_META)
    steps = "transform(sequence(0, 1500), i -> i / 1500D)"
    w, h = "pixel_width * n_cols", "pixel_height * n_rows"
    sides = [(f"x0 + t * {w}", "y0"), (f"x0 + t * {w}", f"y0 - {h}"), ("x0", f"y0 - t * {h}"), (f"x0 + {w}", f"y0 - t * {h}")]
    trace = meta.withColumn("t", F.explode(F.expr(steps)))
    trace = trace.withColumn("p", F.explode(F.expr("array(" + ", ".join(f"named_struct('px', {x}, 'py', {y})" for x, y in sides) + ")"))).selectExpr("raster_id", "zone", "south", "p.px", "p.py")
    dense = geo.add_stages(trace, geo.lonlat_stages("px", "py", "zone", "south")).groupBy("raster_id").agg(F.min("lon").alias("w"), F.min("lat").alias("s"), F.max("lon").alias("e"), F.max("lat").alias("n"))
    for r in spatial.raster_bounds(meta).join(dense, "raster_id").collect():
        assert r.xmin <= r.w and r.ymin <= r.s and r.xmax >= r.e and r.ymax >= r.n
        spare = max(r.w - r.xmin, r.s - r.ymin, r.xmax - r.e, r.ymax - r.n)
        assert spare <= 0.02 * max(r.e - r.w, r.n - r.s) + 1e-6
