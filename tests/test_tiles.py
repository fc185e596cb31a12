"""Stored pixel tiles against the pixel rows, and where the join reads them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from registry import base as b
from tests.test_spatial import meta, pixels, points
from tidemark.operators import spatial, tiles
from tidemark.plans import impact as plan

VALUES = {(r, c): float((r * 7 + c * 3) % 11 - 2) if (r + c) % 5 else -9999.0 for r in range(10) for c in range(10) if (r * c) % 7 != 3}


@pytest.mark.parametrize("size,copies", [(4, 1), (1, 1), (32, 3), (7, 2)])
def test_tiles_equal_pixel_rows(spark, tmp_path, size, copies):
    rng = np.random.default_rng(1)
    places = list(zip(rng.uniform(-82.3, -80.7, 400), rng.uniform(26.7, 28.3, 400)))
    px = pixels(spark, VALUES)
    tiles.write_tiles(px, str(tmp_path / "t"), size, copies, buckets=4)
    rows = spatial.every_raster(points(spark, places), meta(spark), ["grid"])
    located = spatial.grid_position(rows, "longitude", "latitude")
    stored = tiles.read_tiles(spark, str(tmp_path / "t"))
    assert (stored.size, stored.copies) == (size, copies)
    a, c = (sorted(map(str, spatial.sample_depth(located, p).collect())) for p in (px, stored))
    assert a == c and len(a) == 400
    with pytest.raises(Exception):
        tiles.write_tiles(px, str(tmp_path / "t"), size, copies, buckets=4)


def test_a_pixel_given_twice_is_an_error(spark):
    twice = pixels(spark, VALUES).union(pixels(spark, {(0, 0): 1.0}))
    with pytest.raises(Exception, match="(?i)duplicate"):
        tiles.pixel_tiles(twice).collect()


def test_negative_positions_and_nulls(spark):
    df = spark.createDataFrame([("g", -1, -1, 2.0), ("g", -33, 5, 3.0), ("g", 0, 0, None)], "raster_id string, r int, c int, value double")
    cut = tiles.pixel_tiles(df, 32)
    back = cut.select("raster_id", "tile", F.posexplode("cells").alias("at", "value")).where("value IS NOT NULL")
    r = (F.shiftright("tile", 32) * 32 + F.floor(F.col("at") / 32)).cast("int")
    tile_col = (F.col("tile") - F.shiftright("tile", 32) * (1 << 32)).cast("long")
    got = {(x.r, x.value) for x in back.select(r.alias("r"), "value", tile_col).collect()}
    # a column of tile -1 borrows from the row: positions stay distinct
    assert len(got) == 2 and cut.count() == 2


def test_stored_tiles_do_not_move(spark, sf, tmp_path):
    """A whole run over stored tiles: only buildings are shuffled to them."""
    n = spark.conf.get("spark.sql.shuffle.partitions")
    tiles.write_tiles(b.pixels(spark, sf), str(tmp_path / "t"), buckets=int(n))
    stored = tiles.read_tiles(spark, str(tmp_path / "t"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spatial.with_meta(plan.clipped_inventory(b.bldg(spark, sf), b.meta(spark, sf)), b.meta(spark, sf))
        out = spatial.sample_depth(spatial.grid_position(rows, "Longitude", "Latitude"), stored)
        node = out._jdf.queryExecution().executedPlan()
        sides = [s for s in joins(node) if "cells" in s]
        assert len(sides) == 1 and "Exchange" not in sides[0] and "Bucketed: true" in sides[0]
        got = out.agg(F.count("*"), F.round(F.sum("depth_grid"), 2)).first()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    plain = spatial.sample_depth(spatial.grid_position(rows, "Longitude", "Latitude"), b.pixels(spark, sf))
    assert got == plain.agg(F.count("*"), F.round(F.sum("depth_grid"), 2)).first()


def joins(node):
    """The right sides of the joins of a plan, as text."""
    node = node.inputPlan() if node.nodeName() == "AdaptiveSparkPlan" else node
    out = [node.children().apply(1).toString()] if "Join" in node.nodeName() else []
    for i in range(node.children().size()):
        out += joins(node.children().apply(i))
    return out


def test_run_over_tiles(spark, sf, tmp_path):
    tiles.write_tiles(b.pixels(spark, sf), str(tmp_path / "t"), 16)
    stored = tiles.read_tiles(spark, str(tmp_path / "t"))
    a, c = (plan.damage_by_raster(b.bldg(spark, sf), b.meta(spark, sf), p, b.lookups(spark)) for p in (b.pixels(spark, sf), stored))
    total = lambda df: sorted(map(tuple, df.groupBy("GridName", "status").agg(F.count("*"), F.round(F.sum("BldgLossUSD"), 2)).collect()))
    assert total(a) == total(c)


def test_rasters_under_many_rows_are_split(spark):
    few = spark.createDataFrame([("a", 1), ("b", 2)], "raster_id string, m int")
    many = spark.range(5000).select(F.lit("a").alias("raster_id"), "id").union(spark.range(10).select(F.lit("b"), "id"))
    out = spatial.with_meta(many, few)
    assert out.groupBy("raster_id", "m").count().collect() and out.count() == 5010 and out.columns == ["raster_id", "id", "m"]
    from tidemark.operators.joins import SPREAD, with_few

    dealt = with_few(many, few, "raster_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "_copy" in dealt and SPREAD > 1
