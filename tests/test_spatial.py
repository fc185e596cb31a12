"""Raster sampling, projection, cells, boundaries and the GeoTIFF reader."""

import math
import struct
import zlib

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions import geo
from tidemark.operators import boundaries, spatial
from tidemark.sources import raster

PLAIN = ("grid", -82.0, 28.0, 0.1, 0.1, 10, 10, -9999.0, False, None, False)


def meta(spark, *rows):
    return spark.createDataFrame(list(rows) or [PLAIN], schema.RASTER_META)


def pixels(spark, values):
    return spark.createDataFrame([("grid", r, c, float(v)) for (r, c), v in values.items()], schema.RASTER_PIXELS)


def points(spark, rows):
    return spark.createDataFrame([(f"b{i}", float(x), float(y)) for i, (x, y) in enumerate(rows)], "id string, longitude double, latitude double")


def sample(spark, places, values, m=None, **kw):
    m = meta(spark) if m is None else m
    rows = spatial.every_raster(points(spark, places), m, [r.raster_id for r in m.select("raster_id").collect()])
    located = spatial.grid_position(rows, "longitude", "latitude")
    out = spatial.sample_depth(located, pixels(spark, values), **kw)
    return {r.id: r.depth_grid for r in out.collect()}


@pytest.mark.parametrize("kw", [{}, {"salts": 3, "salt_on": "id"}])
def test_sampling_edges(spark, kw):
    places = [(-81.95, 27.95), (-82.05, 28.05), (-82.15, 27.95), (-80.95, 27.95), (-81.85, 27.95), (-81.75, 27.95)]
    got = sample(spark, places, {(0, 0): 3.5, (0, 1): -9999, (0, 2): -2.0}, **kw)
    # the second point lies less than one pixel outside and still gets pixel (0, 0)
    assert [got[f"b{i}"] for i in range(6)] == [3.5, 3.5, 0.0, 0.0, 0.0, -2.0]


def test_utm_known_points(spark):
    # public worked values: 51.2 N 7.5 E in zone 32; the exceptions around Norway and Svalbard
    df = points(spark, [(7.5, 51.2), (-81.0, 0.0), (174.74, -36.85)])
    got = {r.id: (r.utm_x, r.utm_y) for r in spatial.project_utm(df, "longitude", "latitude").collect()}
    assert got["b0"] == (pytest.approx(395201.31, abs=0.02), pytest.approx(5673135.24, abs=0.02))
    assert got["b1"] == (pytest.approx(500000.0, abs=1e-6), pytest.approx(0.0, abs=1e-6))
    assert got["b2"][1] > 5e6
    zones = spark.createDataFrame([(60.0, 4.0), (78.0, 8.0), (78.0, 10.0), (78.0, 25.0), (78.0, 36.0), (30.0, 179.9), (30.0, -180.0)], "lat double, lon double")
    assert [r[0] for r in zones.select(geo.utm_zone(F.col("lat"), F.col("lon"))).collect()] == [32, 31, 33, 35, 37, 60, 1]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.floats(-179, 179), st.floats(-80, 80)), min_size=1, max_size=30))
def test_utm_round_trip(spark, places):
    df = points(spark, places).withColumn("zone", geo.utm_zone(F.col("latitude"), F.col("longitude")))
    there = spatial.project_utm(df, "longitude", "latitude", F.col("zone"))
    back = geo.add_stages(there, geo.lonlat_stages("utm_x", "utm_y", "zone", "latitude < 0"))
    for r in back.collect():
        assert r.lat == pytest.approx(r.latitude, abs=1e-6)
        assert math.remainder(r.lon - r.longitude, 360) == pytest.approx(0, abs=1e-5)


def test_projected_raster_building(spark):
    """A 10 x 10 grid of 100 m pixels in zone 17, one building in it, depth 3.5."""
    place = points(spark, [(-81.0, 27.5)])
    x, y = spatial.project_utm(place, "longitude", "latitude").select("utm_x", "utm_y").first()
    m = meta(spark, ("grid", x - 500, y + 500, 100.0, 100.0, 10, 10, -9999.0, True, 17, False))
    values = {(r, c): 3.5 for r in range(10) for c in range(10)}
    assert sample(spark, [(-81.0, 27.5), (-81.2, 27.5)], values, m) == {"b0": 3.5, "b1": 0.0}
    box = spatial.raster_bounds(m).first()
    assert box.xmin < -81.0 < box.xmax and box.ymin < 27.5 < box.ymax
    assert box.xmax - box.xmin == pytest.approx(1000 / (111320 * math.cos(math.radians(27.5))), rel=0.01)
    kept = spatial.bbox_join(points(spark, [(-81.0, 27.5), (-81.2, 27.5)]), spatial.raster_bounds(m))
    assert [r.id for r in kept.collect()] == ["b0"]
    cells = spatial.wet_cells(pixels(spark, values), m, 0.015625)
    assert spatial.cell_prefilter(place, cells, 0.015625).count() == 1


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.sets(st.tuples(st.integers(0, 9), st.integers(0, 9)), min_size=1, max_size=12),
    st.lists(st.tuples(st.floats(-82.0999, -80.9), st.floats(26.9, 28.0999)), min_size=1, max_size=40),
)
def test_prefilter_loses_no_wet_building(spark, wet, places):
    values = dict.fromkeys(wet, 2.0)
    depths = sample(spark, places, values)
    cells = spatial.wet_cells(pixels(spark, values), meta(spark), 0.0625)
    kept = {r.id for r in spatial.cell_prefilter(points(spark, places), cells, 0.0625).collect()}
    assert {k for k, v in depths.items() if v > 0} <= kept


def test_stride_is_row_major(spark):
    values = {(r, c): 1.0 for r in range(4) for c in range(5)}
    picked = spatial.every_nth_wet(pixels(spark, values), 3).select("r", "c").collect()
    want = sorted(values)[::3]
    assert sorted((r.r, r.c) for r in picked) == want


def test_rasters_over_matches_bbox_join(spark):
    m = meta(spark, PLAIN, ("other", -81.5, 27.8, 0.1, 0.1, 20, 5, None, False, None, False))
    rng = np.random.default_rng(7)
    df = points(spark, zip(rng.uniform(-83, -79, 300), rng.uniform(26, 29, 300)))
    bounds = spatial.raster_bounds(m)
    pairs = {(r.id, r.raster_id) for r in spatial.bbox_join(df, bounds).collect()}
    over = spatial.rasters_over(df, bounds).select("id", F.explode("raster_ids").alias("raster_id")).collect()
    assert pairs == {(r.id, r.raster_id) for r in over} and pairs


def edges(spark, polygons):
    rows = [(k, i, [(float(x), float(y)) for x, y in ring]) for k, rings in polygons.items() for i, ring in enumerate(rings)]
    df = spark.createDataFrame(rows, "geo_id string, ring int, points array<struct<x: double, y: double>>")
    return boundaries.polygon_edges(df)


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x > (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


SHAPES = {
    "tri": [[(0.0, 0.0), (2.3, 0.4), (1.1, 1.9)]],
    "hole": [[(3.0, 0.0), (5.0, 0.0), (5.0, 2.0), (3.0, 2.0)], [(3.6, 0.6), (4.4, 0.6), (4.4, 1.4), (3.6, 1.4)]],
    "dent": [[(0.0, 3.0), (4.0, 3.0), (4.0, 5.0), (2.1, 3.7), (0.0, 5.0)]],
}


@pytest.mark.parametrize("cell", [0.125, 0.5, 4.0])
def test_point_in_polygon_against_ray_casting(spark, cell):
    rng = np.random.default_rng(3)
    places = list(zip(rng.uniform(-0.5, 5.5, 800), rng.uniform(-0.5, 5.5, 800)))
    got = boundaries.assign_county(points(spark, places), edges(spark, SHAPES), cell=cell, outside="keep")
    for r in got.collect():
        want = [k for k, rings in SHAPES.items() if inside(rings, r.longitude, r.latitude)]
        assert ([r.geo_id] if r.geo_id else []) == want
    dropped = boundaries.assign_county(points(spark, places), edges(spark, SHAPES), cell=cell)
    assert dropped.count() == got.where("geo_id IS NOT NULL").count()


def test_extent_meets_polygons(spark):
    def box(name, x0, y0, x1, y1):
        return (name, float(x0), float(y1), (x1 - x0) / 10, (y1 - y0) / 10, 10, 10, None, False, None, False)

    m = meta(spark, box("around", -1, -1, 6, 6), box("within", 3.1, 0.1, 3.3, 0.3), box("hole", 3.8, 0.8, 4.2, 1.2), box("far", 9, 9, 10, 10))
    pairs = boundaries.boundaries_in_extent(edges(spark, SHAPES), spatial.raster_bounds(m), 0.5)
    assert {(r.raster_id, r.geo_id) for r in pairs.collect()} == {("around", "tri"), ("around", "hole"), ("around", "dent"), ("within", "hole")}


def tiff(array, x0, y0, size, nodata="-9999", epsg=None, deflate=False, tile=None):
    """A small GeoTIFF in memory: header, blocks, tag values, directory."""
    h, w = array.shape
    if tile:
        padded = np.zeros((-(-h // tile) * tile, -(-w // tile) * tile), array.dtype)
        padded[:h, :w] = array
        blocks = [padded[r : r + tile, c : c + tile] for r in range(0, h, tile) for c in range(0, w, tile)]
    else:
        blocks = [array[r : r + 3] for r in range(0, h, 3)]
    data = [zlib.compress(b.tobytes()) if deflate else b.tobytes() for b in blocks]
    body, offsets = b"", []
    for d in data:
        offsets.append(8 + len(body))
        body += d
    keys = [1, 1, 0, 1 + bool(epsg), 1024, 0, 1, 1 if epsg else 2] + ([3072, 0, 1, epsg] if epsg else [])
    tags = [(256, "I", [w]), (257, "I", [h]), (258, "H", [array.dtype.itemsize * 8]), (259, "H", [8 if deflate else 1]),
            (339, "H", [3 if array.dtype.kind == "f" else 2]), (33550, "d", [size, size, 0.0]), (33922, "d", [0, 0, 0, x0, y0, 0]),
            (34735, "H", keys), (42113, "c", [bytes([b]) for b in nodata.encode() + b"\0"])]
    if tile:
        tags += [(322, "H", [tile]), (323, "H", [tile]), (324, "I", offsets), (325, "I", [len(d) for d in data])]
    else:
        tags += [(273, "I", offsets), (278, "H", [3]), (279, "I", [len(d) for d in data])]
    code = {"H": 3, "I": 4, "d": 12, "c": 2}
    start = 8 + len(body)
    extra_at = start + 2 + 12 * len(tags) + 4
    directory, extra = struct.pack("<H", len(tags)), b""
    for tag, kind, values in sorted(tags):
        raw = struct.pack(f"<{len(values)}{kind}", *values)
        if len(raw) <= 4:
            field = raw.ljust(4, b"\0")
        else:
            field = struct.pack("<I", extra_at + len(extra))
            extra += raw
        directory += struct.pack("<HHI", tag, code[kind], len(values)) + field
    return b"II" + struct.pack("<HI", 42, start) + body + directory + struct.pack("<I", 0) + extra


@pytest.mark.parametrize("kw", [{}, {"deflate": True}, {"tile": 16}, {"deflate": True, "tile": 16, "epsg": 32617}])
def test_geotiff(spark, tmp_path, kw):
    array = (np.arange(20 * 33).reshape(20, 33) % 7).astype("<f4")
    array[4, 5] = -9999
    (tmp_path / "IAN_2022_adv31_e10_ResultMaskRaster.tif").write_bytes(tiff(array, -82.0, 28.0, 0.5, **kw))
    head = raster.read_raster_meta(spark, str(tmp_path)).first()
    assert (head.x0, head.y0, head.pixel_width, head.n_cols, head.n_rows, head.nodata) == (-82.0, 28.0, 0.5, 33, 20, -9999.0)
    assert (head.projected, head.zone) == (("epsg" in kw), 17 if "epsg" in kw else None)
    got = {(r.r, r.c): r.value for r in raster.read_raster_pixels(spark, str(tmp_path)).collect()}
    assert len(got) == array.size - 1 and all(array[k] == v for k, v in got.items())


def test_integer_raster_codes(spark, tmp_path):
    array = (np.arange(9 * 4).reshape(9, 4) % 8).astype("<i2")
    (tmp_path / "codes.tif").write_bytes(tiff(array, 0.0, 0.0, 1.0, nodata="7"))
    px = raster.read_raster_pixels(spark, str(tmp_path))
    feet = {r.value for r in spatial.remap_codes(px, unmapped="drop").collect()}
    assert feet == {1.0, 3.0, 6.0, 9.0}
    assert spatial.remap_codes(px, nodata=-1).where("value = -1").count() == px.where("value NOT IN (1,2,3,4,5)").count()


def test_stored_inventory_is_read_by_range_and_state(spark, sf, tmp_path):
    """Extents and states of an event reach the scan; a far state is not read."""
    from registry import base as b
    from tidemark.plans import impact as plan
    from tidemark.sinks import writers
    from tidemark.sources.inventory import read_inventory

    path = str(tmp_path / "inventory")
    rows = b.bldg(spark, sf).withColumn("num_story", F.col("num_story").cast("long"))
    far = rows.withColumns({"state": F.lit("Texas"), "latitude": F.col("latitude") + 20})
    writers.write_inventory(rows.where("state <> 'Texas'").unionByName(far), path)
    stored = read_inventory(spark, path)
    near = plan.clipped_inventory(stored, b.meta(spark, sf), states=["Florida", "Georgia"])
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    text = near._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in text.splitlines() if "PushedFilters" in line and "val_struct" in line)
    assert "GreaterThanOrEqual(latitude" in scan and "LessThanOrEqual(longitude" in scan
    assert "state" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r["state"] for r in near.select("state").distinct().collect()} == {"Florida", "Georgia"}
    every = plan.clipped_inventory(stored, b.meta(spark, sf))
    assert every.where("state = 'Texas'").count() == 0
    # an id that also stands in a state left out may lose its best row to that one
    assert 0 < every.where("state in ('Florida', 'Georgia')").count() <= near.count()


def test_raster_without_extent_is_refused(spark, sf):
    from registry import base as b
    from tidemark.plans import impact as plan

    unknown = b.meta(spark, sf).withColumns({"projected": F.lit(True), "zone": F.lit(None).cast("int")})
    with pytest.raises(ValueError):
        plan.clipped_inventory(b.bldg(spark, sf), unknown)
