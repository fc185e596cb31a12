"""Cells of boundaries against ray casting, with edges on cell borders and long rings."""

from fractions import Fraction

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.test_spatial import edges, points
from tidemark.operators import boundaries


def inside(rings, x, y):
    """Even-odd rule in exact arithmetic: ends at the ray's height count as below, crossings at x as not left."""
    x, y, odd = Fraction(x), Fraction(y), False
    for ring in rings:
        for a, b in zip(ring, ring[1:] + ring[:1]):
            (x1, y1), (x2, y2) = tuple(map(Fraction, a)), tuple(map(Fraction, b))
            if (y1 > y) != (y2 > y) and x1 + (y - y1) * (x2 - x1) / (y2 - y1) < x:
                odd = not odd
    return odd


def found(spark, shapes, places, cell):
    out = boundaries.points_in_boundaries(points(spark, places), edges(spark, shapes), cell=cell)
    return sorted((r.longitude, r.latitude, r.geo_id) for r in out.collect())


def wanted(shapes, places):
    return sorted((float(x), float(y), k) for x, y in places for k, rings in shapes.items() if inside(rings, x, y))


GRID = [(i / 4, j / 4) for i in range(-2, 26) for j in range(-2, 18)]


@pytest.mark.parametrize("cell", [0.25, 0.5, 1.0, 3.0])
def test_vertices_edges_and_places_on_cell_borders(spark, cell):
    shapes = {
        "box": [[(1.0, 1.0), (4.0, 1.0), (4.0, 3.0), (1.0, 3.0)]],
        "stair": [[(0.0, 0.0), (2.0, 0.0), (2.0, 1.0), (3.0, 1.0), (3.0, 2.0), (5.0, 2.0), (5.0, 4.0), (0.0, 4.0)]],
        "diamond": [[(3.0, 0.0), (5.0, 2.0), (3.0, 4.0), (1.0, 2.0)]],
        "ring": [[(0.0, 0.0), (6.0, 0.0), (6.0, 4.0), (0.0, 4.0)], [(1.0, 1.0), (1.0, 3.0), (5.0, 3.0), (5.0, 1.0)]],
    }
    assert found(spark, shapes, GRID, cell) == wanted(shapes, GRID)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 24), st.integers(0, 16)), min_size=3, max_size=14, unique=True), st.sampled_from([0.25, 0.75, 2.0]))
def test_any_ring_even_one_that_crosses_itself(spark, ring, cell):
    shapes = {"a": [[(x / 4, y / 4) for x, y in ring]]}
    assert found(spark, shapes, GRID, cell) == wanted(shapes, GRID)


def test_tenths_where_cells_and_edges_are_rounded(spark):
    """Cell borders, vertices and places in tenths: none of them is exact, all lie on each other."""
    shapes = {"a": [[(0.1, 0.1), (0.7, 0.1), (0.7, 0.3), (0.4, 0.6), (0.1, 0.3)]], "b": [[(0.3, 0.2), (0.9, 0.8), (0.3, 0.8)]]}
    places = [(i / 10, j / 10) for i in range(12) for j in range(12)] + [(i / 20, j / 30) for i in range(22) for j in range(30)]
    # places within rounding of an edge may fall on either side, but alike for every cell size
    first = found(spark, shapes, places, 0.1)
    assert first == found(spark, shapes, places, 0.3) == found(spark, shapes, places, 7.0)
    off = [p for p in places if not any(abs((x2 - x1) * (p[1] - y1) - (y2 - y1) * (p[0] - x1)) < 1e-9 for r in shapes.values() for (x1, y1), (x2, y2) in zip(r[0], r[0][1:] + r[0][:1]))]
    assert [f for f in first if f[:2] in set(off)] == wanted(shapes, off)


def ring_of(n, rough=0.02):
    rng = np.random.default_rng(4)
    angle = np.arange(n) * 2 * np.pi / n
    radius = 2.0 + 0.5 * np.sin(5 * angle) + rough * rng.uniform(size=n) / 100
    return list(zip((radius * np.cos(angle)).tolist(), (radius * np.sin(angle)).tolist()))


def test_ring_of_many_edges(spark):
    """100,000 edges: a cell stores those that pass it, about once each in all."""
    n, cell = 100_000, 0.125
    ring = ring_of(n)
    frame = spark.createDataFrame([("a", 0, i, *ring[i], *ring[(i + 1) % n]) for i in range(n)], "geo_id string, ring int, seq int, x1 double, y1 double, x2 double, y2 double")
    cover = boundaries.cell_cover(frame, cell).cache()
    assert cover.agg(F.sum(F.coalesce(F.size("edges"), F.lit(0)))).first()[0] < 1.05 * n
    assert cover.agg(F.max(F.size("edges"))).first()[0] < n / 50
    rng = np.random.default_rng(5)
    places = list(zip(rng.uniform(-2.7, 2.7, 2000).tolist(), rng.uniform(-2.7, 2.7, 2000).tolist()))
    got = {r.id for r in boundaries.points_in_boundaries(points(spark, places), frame, cell=cell).collect()}
    x1, y1 = np.array(ring).T
    x2, y2 = np.roll(x1, -1), np.roll(y1, -1)
    for i, (x, y) in enumerate(places):
        spans = (y1 > y) != (y2 > y)
        left = x1[spans] + (y - y1[spans]) * (x2[spans] - x1[spans]) / (y2[spans] - y1[spans]) < x
        assert (f"b{i}" in got) == bool(left.sum() % 2)
    cover.unpersist()


def test_long_edges_pass_few_cells(spark):
    frame = edges(spark, {"a": [[(0.0, 0.0), (100.0, 99.0), (0.0, 1.0)]]})
    assert boundaries.edge_cells(frame, 1.0).count() < 700
    assert "collect_list" not in boundaries.edge_cells(frame, 1.0)._jdf.queryExecution().optimizedPlan().toString()
