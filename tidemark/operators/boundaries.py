"""Polygons as edge rows: states in a raster extent, points in counties.

A boundary is rows ``(geo_id, ring, seq, x1, y1, x2, y2)``, one per polygon edge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import geo

EDGE = ["x1", "y1", "x2", "y2"]


def polygon_edges(polygons: DataFrame, key: str = "geo_id", ring: str = "ring", points: str = "points") -> DataFrame:
    """Rings given as ``array<struct<x, y>>`` to edge rows; open rings are closed."""
    p = F.col(points)
    closed = F.when(p[0] == F.element_at(p, -1), p).otherwise(F.concat(p, F.array(p[0])))
    pairs = F.transform(
        F.sequence(F.lit(0), F.size("_closed") - 2),
        lambda i: F.struct(F.get("_closed", i).alias("a"), F.get("_closed", i + 1).alias("b")),
    )
    return (
        polygons.withColumn("_closed", closed)
        .select(F.col(key).alias("geo_id"), F.col(ring).alias("ring"), F.posexplode(pairs).alias("seq", "e"))
        .select(
            "geo_id",
            "ring",
            "seq",
            F.col("e.a.x").alias("x1"),
            F.col("e.a.y").alias("y1"),
            F.col("e.b.x").alias("x2"),
            F.col("e.b.y").alias("y2"),
        )
    )


def _span(lo: Column, hi: Column, cell: float) -> Column:
    return F.sequence(geo.cell_index(lo, cell), geo.cell_index(hi, cell))


# cells are widened by this share, so that an edge on their border is in both neighbours
MARGIN = 1e-6


def edge_cells(edges: DataFrame, cell: float) -> DataFrame:
    """Edge rows once per cell that the edge passes: columns ``cx``, ``cy``, ``crosses`` are added.

    The edge is followed row by row, so a long edge gives as many rows as it passes cells.
    ``crosses`` marks the one cell in whose south side, its west end excluded, the edge crosses it.
    """
    m = cell * MARGIN
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    banded = edges.withColumn("cy", F.explode(_span(low - m, high + m, cell)))
    south = F.col("cy") * F.lit(cell)

    def x_at(y: Column) -> Column:
        x = F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
        return F.least(F.greatest(x, F.least("x1", "x2")), F.greatest("x1", "x2"))

    level = F.col("y1") == F.col("y2")
    enter, leave = x_at(F.greatest(low, south - m)), x_at(F.least(high, south + F.lit(cell + m)))
    ends = banded.withColumns(
        {
            "_a": F.when(level, F.least("x1", "x2")).otherwise(F.least(enter, leave)) - m,
            "_b": F.when(level, F.greatest("x1", "x2")).otherwise(F.greatest(enter, leave)) + m,
            "_near": F.when(~level, geo.cell_index(x_at(south), cell)),
        }
    )
    # the crossing's column is the last one whose west end is not right of it, by the ray test itself
    edge = F.struct(*EDGE)
    left = [geo.crosses_left_of((F.col("_near") + k) * F.lit(cell), south, edge) for k in (0, 1)]
    spans = (F.col("y1") > south) != (F.col("y2") > south)
    column = F.col("_near") + F.when(~left[1], 1).when(left[0], -1).otherwise(0)
    placed = ends.withColumn("_at", F.when(spans, column))
    first, last = geo.cell_index(F.col("_a"), cell), geo.cell_index(F.col("_b"), cell)
    every = F.sequence(F.least(first, F.coalesce("_at", first)), F.greatest(last, F.coalesce("_at", last)))
    return placed.withColumn("cx", F.explode(every)).select(*edges.columns, "cx", "cy", F.coalesce(F.col("_at") == F.col("cx"), F.lit(False)).alias("crosses"))


def cell_cover(edges: DataFrame, cell: float) -> DataFrame:
    """Cells of each boundary: ``geo_id, cx, cy, whole, odd, edges``.

    A cell that an edge passes keeps the edges in it, and ``odd``: whether its south-west corner lies
    inside. That is the parity of the crossings of the cell's south line further west, a running
    count over the cells of one row. A cell without an edge lies wholly inside or outside; those
    between two passed cells of a row are kept as ``whole`` where the count is odd. Stored edges
    grow with the boundary's length, whatever its height or width.
    """
    passed = edge_cells(edges, cell).groupBy("geo_id", "cx", "cy").agg(
        F.count_if("crosses").alias("_n"), F.collect_list(F.struct(*EDGE)).alias("edges")
    )
    row = Window.partitionBy("geo_id", "cy").orderBy("cx")
    west = F.coalesce(F.sum("_n").over(row.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = passed.withColumns({"_west": west, "_next": F.lead("cx").over(row)})
    gap = F.when(((F.col("_west") + F.col("_n")) % 2 == 1) & (F.col("_next") > F.col("cx") + 1), F.sequence(F.col("cx") + 1, F.col("_next") - 1))
    inside = F.transform(gap, lambda x: F.struct(x.alias("cx"), F.lit(True).alias("whole"), F.lit(True).alias("odd"), F.lit(None).cast("array<struct<x1: double, y1: double, x2: double, y2: double>>").alias("edges")))
    own = F.array(F.struct("cx", F.lit(False).alias("whole"), (F.col("_west") % 2 == 1).alias("odd"), "edges"))
    cells = rows.select("geo_id", "cy", F.explode(F.concat(own, F.coalesce(inside, F.slice(own, 1, 0)))).alias("_c"))
    return cells.select("geo_id", "_c.cx", "cy", "_c.whole", "_c.odd", "_c.edges")


def _inside(px: Column, py: Column, cx: Column, cy: Column, whole: Column, odd: Column, edges: Column, cell: float) -> Column:
    """Whether a place lies in the boundary that a cell belongs to."""
    west, south = cx * F.lit(cell), cy * F.lit(cell)
    crossed = F.size(F.filter(edges, lambda e: geo.crosses_path(px, py, west, south, e)))
    return whole | (odd != (crossed % 2 == 1))


def points_in_boundaries(
    points: DataFrame, edges: DataFrame, lon: str = "longitude", lat: str = "latitude", cell: float = 0.25
) -> DataFrame:
    """Pairs of point and containing boundary (even-odd rule over closed rings)."""
    px, py = F.col(lon), F.col(lat)
    held = _inside(px, py, *[F.col(c) for c in ("cx", "cy", "whole", "odd", "edges")], cell)
    placed = points.withColumn("cx", geo.cell_index(px, cell)).withColumn("cy", geo.cell_index(py, cell))
    return placed.join(cell_cover(edges, cell), ["cx", "cy"]).where(held).select(*points.columns, "geo_id")


def assign_county(
    points: DataFrame,
    edges: DataFrame,
    lon: str = "longitude",
    lat: str = "latitude",
    cell: float = 0.25,
    outside: str = "drop",
) -> DataFrame:
    """County of each point. ``outside="keep"`` leaves points in no county with NULL.

    Neighbouring counties share edges, not area, so a point has at most one.
    """
    if outside == "drop":
        return points_in_boundaries(points, edges, lon, lat, cell)
    # candidates of one cell meet in one row, so no point is grouped or matched again
    px, py = F.col(lon), F.col(lat)
    cover = cell_cover(edges, cell).groupBy("cx", "cy").agg(F.collect_list(F.struct("geo_id", "whole", "odd", "edges")).alias("cands"))

    def holds(k: Column) -> Column:
        return _inside(px, py, F.col("cx"), F.col("cy"), k["whole"], k["odd"], k["edges"], cell)

    hit = F.array_min(F.transform(F.filter("cands", holds), lambda k: k["geo_id"]))
    placed = points.withColumn("cx", geo.cell_index(px, cell)).withColumn("cy", geo.cell_index(py, cell))
    return placed.join(cover, ["cx", "cy"], "left").select(*points.columns, hit.alias("geo_id"))


def boundaries_in_extent(edges: DataFrame, bounds: DataFrame, cell: float = 1.0) -> DataFrame:
    """Pairs ``(raster_id, geo_id)`` whose polygon meets the raster rectangle.

    Either an edge meets the rectangle, or the rectangle lies inside the polygon, which
    one of its corners shows. Both tests run on cell equi-joins.
    """
    box = bounds.select("raster_id", "xmin", "ymin", "xmax", "ymax")
    listed = box.withColumn("cx", F.explode(_span(F.col("xmin"), F.col("xmax"), cell))).withColumn(
        "cy", F.explode(_span(F.col("ymin"), F.col("ymax"), cell))
    )
    placed = edge_cells(edges, cell)
    ends = [F.col(c) for c in EDGE]
    meets = geo.edge_meets_box(*ends, F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"))
    by_edge = placed.join(listed, ["cx", "cy"]).where(meets).select("raster_id", "geo_id")
    by_corner = points_in_boundaries(box, edges, "xmin", "ymin", cell).select("raster_id", "geo_id")
    return by_edge.union(by_corner).distinct()


def states_in_extent(edges: DataFrame, bounds: DataFrame, names: DataFrame, cell: float = 1.0) -> DataFrame:
    """Names of the states that meet each raster extent; none is a valid answer.

    ``names``: ``geo_id, NAME``.
    """
    pairs = boundaries_in_extent(edges, bounds, cell)
    return pairs.join(names, "geo_id").select("raster_id", "NAME").distinct()


def ingest_completeness(expected: DataFrame, loaded: DataFrame, edges: DataFrame, bounds: DataFrame) -> DataFrame:
    """Counties that were expected but not loaded, with a severity.

    ``error`` where the county meets a raster extent or nothing of its state was
    loaded, ``warn`` otherwise. ``cacheable`` is false for each state with a failure.
    ``expected``: ``state, county``; ``loaded``: ``county``.
    """
    seen = loaded.select("county").distinct()
    flagged = expected.join(seen.withColumn("_ok", F.lit(True)), "county", "left")
    state_has = flagged.groupBy("state").agg(F.count("_ok").alias("_n"))
    failed = flagged.where(F.col("_ok").isNull()).join(state_has, "state")
    wet = boundaries_in_extent(edges, bounds).select(F.col("geo_id").alias("county")).distinct()
    meets = failed.join(wet.withColumn("_wet", F.lit(True)), "county", "left")
    severity = F.when(F.col("_n") == 0, F.lit("error")).when(F.col("_wet"), F.lit("error")).otherwise(F.lit("warn"))
    return meets.select(
        "state",
        "county",
        F.coalesce("_wet", F.lit(False)).alias("meets_raster"),
        severity.alias("severity"),
        F.lit(False).alias("cacheable"),
    )
