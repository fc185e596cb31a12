"""Raster footprints, depth sampling and the wet-cell prefilter.

A raster is one row of metadata plus long rows ``(raster_id, r, c, value)``. Sampling
is an equi-join, so any number of rasters runs in one plan and no raster array is
ever shipped to a task.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import fixed, geo
from tidemark.operators.extents import BOUNDS, Survey, survey
from tidemark.operators.joins import HELD, fenced, replicated, row_hash, salted, with_few
from tidemark.operators.tiles import TiledPixels, look_up

EDGE_SAMPLES = 21


def raster_bounds(meta: DataFrame) -> DataFrame:
    """Add the WGS84 extent of each raster.

    A projected raster is traced along its four edges and each sample is brought back
    to longitude and latitude, because straight edges bend under the projection. The
    extent is widened by the most that an edge can bend between two samples.
    """
    steps = f"sequence(0, {EDGE_SAMPLES})"
    n = f"{float(EDGE_SAMPLES)}D"
    edges = ", ".join(
        f"transform({steps}, i -> named_struct('x', {x}, 'y', {y}))"
        for x, y in (
            (f"_w + (_e - _w) * i / {n}", "_n"),
            (f"_w + (_e - _w) * i / {n}", "_s"),
            ("_w", f"_s + (_n - _s) * i / {n}"),
            ("_e", f"_s + (_n - _s) * i / {n}"),
        )
    )
    stages = geo.lonlat_stages("p.x", "p.y", "zone", "coalesce(south, false)")
    ring = geo.map_stages("_ring", stages, {"x": "p.x", "y": "p.y"})
    sides = meta.selectExpr(
        "*",
        "x0 AS _w",
        "y0 AS _n",
        "x0 + pixel_width * n_cols AS _e",
        "y0 - pixel_height * n_rows AS _s",
        "coalesce(projected, false) AS _p",
    )
    traced = sides.withColumn("_ring", F.expr(f"CASE WHEN _p THEN concat({edges}) END")).withColumn("_ring", F.expr(ring))
    parts = (("xmin", "min", "lon", "_w"), ("ymin", "min", "lat", "_s"), ("xmax", "max", "lon", "_e"), ("ymax", "max", "lat", "_n"))
    step = f"greatest(_e - _w, _n - _s) / {n}"
    north = f"(CASE WHEN coalesce(south, false) THEN {geo.FALSE_NORTHING!r}D ELSE 0.0D END)"
    bend = geo.bend_degrees(step, "greatest(abs(_w - {0}D), abs(_e - {0}D))".format(geo.FALSE_EASTING), f"greatest(abs(_n - {north}), abs(_s - {north}))")
    extent = [
        f"CASE WHEN _p THEN array_{pick}(transform(_ring, p -> p.{axis})) {'-' if pick == 'min' else '+'} {bend[axis]} ELSE {side} END AS {name}"
        for name, pick, axis, side in parts
    ]
    return traced.selectExpr(*meta.columns, *extent)


def _cells_of_box(cell: float) -> tuple[Column, Column]:
    return (
        F.sequence(geo.cell_index(F.col("xmin"), cell), geo.cell_index(F.col("xmax"), cell)),
        F.sequence(geo.cell_index(F.col("ymin"), cell), geo.cell_index(F.col("ymax"), cell)),
    )


def surveyed(rows: DataFrame, bounds: DataFrame, lon: str = "longitude", lat: str = "latitude", most: int = 32) -> Survey | None:
    """The extents packed and counted by a job over the metadata, where the rows have numeric places."""
    kinds = {f.name: f.dataType for f in rows.select(lon, lat).schema.fields}
    return survey(bounds, most) if all(isinstance(k, T.NumericType) for k in kinds.values()) else None


def near_rasters(rows: DataFrame, bounds: DataFrame, lon: str = "longitude", lat: str = "latitude", most: int = 32, known: Survey | None = None) -> DataFrame:
    """Rows in the packed extents of the rasters, as plain ranges that a stored table can skip by.

    Extents are merged by least added area into ``most`` boxes at most, however many rasters there
    are, so distant storms keep ranges of their own. Only these boxes reach the driver. This narrows
    the scan and decides nothing: the join with the extents stays exact. Rows without a readable
    place stay. Columns that are no doubles are compared as they are stored; text ones are not narrowed.
    ``known``: the survey of the extents, where the caller has it.
    """
    known = known or surveyed(rows, bounds, lon, lat, most)
    if known is None:
        return rows
    x, y = F.col(lon), F.col(lat)
    keep = x.isNull() | y.isNull() | (y > 90) | (y < -90) | (x > 360) | (x < -360)
    for xmin, ymin, xmax, ymax in known.boxes:
        keep = keep | (y.between(ymin, ymax) & x.between(xmin, xmax))
    return rows.where(keep)


# cells of what has no place on earth: rows are dealt to them by hash
NOWHERE, NOWHERE_CELLS = -(1 << 63), 64


def bbox_join(
    buildings: DataFrame,
    bounds: DataFrame,
    lon: str = "longitude",
    lat: str = "latitude",
    cell: float = 1.0,
    nowhere: Column | None = None,
    prune: bool = True,
    known: Survey | None = None,
) -> DataFrame:
    """Pairs of building and raster with the building inside the raster extent.

    Extents are listed per coarse cell, so this is an equi-join on the cell with an
    exact BETWEEN test on top: no nested loop however many rasters there are.
    ``prune`` narrows the scan of the buildings first, see :func:`near_rasters`. Where the extents
    are surveyed and every task can hold their list, it is broadcast and no building moves.

    With ``nowhere``, rows it holds for and rows whose coordinates are NULL or beyond the earth
    share some more cells that every raster lists: they come once per raster.
    """
    if prune and nowhere is None:
        known = known or surveyed(buildings, bounds, lon, lat)
        buildings = near_rasters(buildings, bounds, lon, lat, known=known) if known else buildings
    xs, ys = _cells_of_box(cell)
    listed = bounds.withColumn("_xs", xs).withColumn("_ys", ys)
    cells = F.flatten(F.transform("_xs", lambda x: F.transform("_ys", lambda y: geo.cell_code(x, y))))
    if nowhere is not None:
        beyond = F.transform(F.sequence(F.lit(0), F.lit(NOWHERE_CELLS - 1)), lambda k: F.lit(NOWHERE) + k)
        cells = F.concat(F.coalesce(cells, F.array().cast("array<long>")), beyond)
    # the test of what is beyond stays on this side: on the other it would be worked out once more, below the join
    listed = listed.withColumn("_cell", F.explode(cells)).drop("_xs", "_ys").withColumn("_beyond", F.col("_cell") < NOWHERE + NOWHERE_CELLS)
    code = geo.cell_id(on_earth(lon, 360), on_earth(lat, 90), cell)
    beyond = F.lit(NOWHERE) + F.pmod(row_hash(buildings), F.lit(NOWHERE_CELLS))
    code = code if nowhere is None else F.when(nowhere, beyond).otherwise(code)
    placed = buildings.withColumn("_cell", F.coalesce(code, beyond, F.lit(NOWHERE)))
    inside = F.col(lon).between(F.col("xmin"), F.col("xmax")) & F.col(lat).between(F.col("ymin"), F.col("ymax"))
    entries = math.inf if known is None or cell < 1 else known.cells + (0 if nowhere is None else NOWHERE_CELLS * known.rasters)
    listed = F.broadcast(listed) if entries <= HELD else listed
    return placed.join(listed, "_cell").where(inside | F.col("_beyond")).drop("_cell", "_beyond")


def rasters_over(
    buildings: DataFrame,
    bounds: DataFrame,
    lon: str = "longitude",
    lat: str = "latitude",
    cell: float = 1.0,
    prune: bool = True,
    in_row: int = 256,
    known: Survey | None = None,
) -> DataFrame:
    """Buildings inside any raster extent, with the sorted array ``raster_ids``.

    The same test as :func:`bbox_join` without multiplying rows: each coarse cell
    carries the extents that touch it (metadata, one entry per raster), ``in_row`` in
    one array. Where more rasters touch a cell, a building may come once for each
    array, with the rasters of that array. Where the extents are surveyed and every task can hold
    their list, it is broadcast and no building moves.
    """
    if prune:
        known = known or surveyed(buildings, bounds, lon, lat)
        buildings = near_rasters(buildings, bounds, lon, lat, known=known) if known else buildings
    xs, ys = _cells_of_box(cell)
    box = F.struct("raster_id", *BOUNDS).alias("_box")
    listed = bounds.withColumn("_cx", F.explode(xs)).withColumn("_cy", F.explode(ys)).select("_cx", "_cy", box)
    place = F.row_number().over(Window.partitionBy("_cx", "_cy").orderBy("_box"))
    numbered = listed.withColumn("_k", F.floor((place - 1) / in_row))
    per_cell = numbered.groupBy("_cx", "_cy", "_k").agg(F.array_sort(F.collect_list("_box")).alias("_boxes"))
    placed = buildings.withColumns(
        {"_cx": geo.cell_index(F.col(lon), cell), "_cy": geo.cell_index(F.col(lat), cell)}
    )
    inside = f"transform(filter(_boxes, b -> {lon} BETWEEN b.xmin AND b.xmax AND {lat} BETWEEN b.ymin AND b.ymax), b -> b.raster_id)"
    # survey cells are of one degree: larger cells make fewer entries
    per_cell = F.broadcast(per_cell) if known is not None and cell >= 1 and known.cells <= HELD else per_cell
    return (
        placed.join(per_cell, ["_cx", "_cy"])
        .withColumn("raster_ids", F.expr(inside))
        .where(F.size("raster_ids") > 0)
        .drop("_cx", "_cy", "_k", "_boxes")
    )


def on_earth(name: str, most: float) -> Column:
    """The coordinate, or NULL where no place on earth has it; blank coordinates stay 0."""
    return F.when(F.abs(name).between(0, most), F.col(name))


def every_raster(buildings: DataFrame, meta: DataFrame, raster_ids: Sequence[str]) -> DataFrame:
    """Every building once per named raster, also where it lies outside the extent."""
    ids = F.array(*[F.lit(i) for i in raster_ids])
    return with_meta(buildings.withColumn("raster_id", F.explode(ids)), meta)


def project_utm(df: DataFrame, lon: str, lat: str, zone: Column | None = None, where: str = "true") -> DataFrame:
    """Add ``utm_x``, ``utm_y`` in metres, in the point's own zone unless one is given.

    Rows outside ``where`` get NULL and skip the arithmetic.
    """
    own = geo.utm_zone(F.col(lat), F.col(lon)) if zone is None else zone
    gated = df.withColumns({"u_lat": F.expr(f"CASE WHEN {where} THEN {lat} END"), "u_zone": own})
    return geo.add_stages(gated, geo.utm_stages("u_lat", lon, "u_zone")).drop("u_lat", "u_zone")


def grid_position(df: DataFrame, lon: str, lat: str, utm_zone: str = "point") -> DataFrame:
    """Add ``r``, ``c`` and ``in_grid`` from the raster columns on each row.

    Projected rasters use UTM coordinates, in the zone of the point or of the raster.
    """
    if utm_zone not in ("point", "raster"):
        raise ValueError("utm_zone must be 'point' or 'raster'")
    zone = None if utm_zone == "point" else F.col("zone")
    placed = fenced(project_utm(df, lon, lat, zone, "coalesce(projected, false)"), "utm_x")
    gx = F.when(F.col("projected"), F.col("utm_x")).otherwise(F.col(lon))
    gy = F.when(F.col("projected"), F.col("utm_y")).otherwise(F.col(lat))
    return (
        placed.withColumns(
            {
                "c": geo.pixel_index(gx - F.col("x0"), F.col("pixel_width")),
                "r": geo.pixel_index(F.col("y0") - gy, F.col("pixel_height")),
            }
        )
        .withColumn("in_grid", F.expr("c >= 0 AND c < n_cols AND r >= 0 AND r < n_rows"))
        .drop("utm_x", "utm_y")
    )


META_COLUMNS = ["x0", "y0", "pixel_width", "pixel_height", "n_cols", "n_rows", "nodata", "projected", "zone", "south"]


def valid_pixels(pixels: DataFrame, meta: DataFrame) -> DataFrame:
    """Pixels that hold a value: not NULL and not the raster's nodata mark."""
    marks = meta.select("raster_id", "nodata")
    return (
        with_meta(pixels, marks)
        .where(F.col("value").isNotNull() & ~F.col("value").eqNullSafe(F.col("nodata")))
        .drop("nodata")
    )


def with_meta(df: DataFrame, meta: DataFrame, known: Survey | None = None) -> DataFrame:
    """Rows with the metadata of their raster. A raster under a large share of the rows is split."""
    return with_few(df, meta, "raster_id", counted=math.inf if known is None else known.rasters)


def held_pixels(pixels: DataFrame, meta: DataFrame, known: Survey | None) -> DataFrame:
    """The pixels inside the grids of a run, broadcast where the grids have few enough places.

    Pixels of other rasters or beyond the grid are never sampled, so the places of the grids bound
    the table; one of unknown or larger size is left as it is.
    """
    if known is None or known.places > HELD or known.rasters > HELD:
        return pixels
    grids = meta.select(F.col("raster_id").alias("_id"), "n_rows", "n_cols")
    own = (F.col("raster_id") == F.col("_id")) & F.expr("r >= 0 AND r < n_rows AND c >= 0 AND c < n_cols")
    return F.broadcast(pixels.join(F.broadcast(grids), own, "left_semi"))


def sample_depth(
    located: DataFrame,
    pixels: DataFrame | TiledPixels,
    salts: int = 1,
    salt_on: str | None = None,
    meta: DataFrame | None = None,
    known: Survey | None = None,
) -> DataFrame:
    """Add ``depth_grid``: the pixel value under each point, 0 outside or on nodata.

    ``located`` comes from :func:`grid_position`. The pixel side has one row per key,
    so a pixel that holds many buildings can only skew the building side, which
    adaptive execution splits. ``salts > 1`` spreads hot pixels explicitly instead,
    by the hash of ``salt_on``, at the price of repeating the pixels. Stored tiles
    (:mod:`tidemark.operators.tiles`) are looked up where they lie. With the metadata and
    its survey, pixels of small grids are broadcast, see :func:`held_pixels`.
    """
    keys = ["raster_id", "r", "c"]
    depth_grid = F.when(F.col("in_grid") & ~F.col("value").eqNullSafe(F.col("_mark")), F.coalesce("value", F.lit(0.0))).otherwise(F.lit(0.0))
    # the nodata mark is on each building row already, so no pixel meets the metadata
    left = located.withColumn("_mark", F.col("nodata"))
    left = left.drop(*[c for c in META_COLUMNS + BOUNDS if c in left.columns])
    if isinstance(pixels, TiledPixels):
        return look_up(left, pixels, salt_on).withColumn("depth_grid", depth_grid).drop("value", "in_grid", "r", "c", "_mark")
    depth = pixels.where(F.col("value").isNotNull()).select(*keys, "value")
    depth = depth if meta is None or salts > 1 else held_pixels(depth, meta, known)
    if salts > 1:
        left, depth = salted(left, F.col(salt_on), salts), replicated(depth, salts)
        keys = [*keys, "salt"]
    return (
        left.join(depth, keys, "left")
        .withColumn("depth_grid", depth_grid)
        .drop("value", "in_grid", "r", "c", "salt", "_mark")
    )


def every_nth_wet(wet: DataFrame, stride: int) -> DataFrame:
    """Every ``stride``-th wet pixel per raster in row-major order.

    The rank is the wet count of all earlier grid rows plus the rank inside the grid
    row, so no task ever sorts a whole raster.
    """
    if stride == 1:
        return wet
    per_row = wet.groupBy("raster_id", "r").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("raster_id").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_row.select("raster_id", "r", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    in_row = Window.partitionBy("raster_id", "r").orderBy("c")
    return (
        wet.withColumn("_k", F.row_number().over(in_row))
        .join(starts, ["raster_id", "r"])
        .where((F.col("_start") + F.col("_k") - 1) % stride == 0)
        .drop("_k", "_start")
    )


def wet_cells(
    pixels: DataFrame,
    meta: DataFrame,
    cell: float = 0.02,
    stride: int = 1,
    cover: str = "extent",
) -> DataFrame:
    """Distinct coarse cells ``(raster_id, cell)`` touched by water.

    ``cover="extent"`` lists every cell a wet pixel overlaps, so a building in a wet
    pixel always finds its cell; ``cover="centre"`` lists the cell of the pixel centre
    only. A stride above 1 samples the wet pixels and may lose wet buildings.
    """
    full = with_meta(pixels.where("value > 0"), meta).where(~F.col("value").eqNullSafe(F.col("nodata")))
    grid = every_nth_wet(full, stride)

    # index 0 also serves points just outside the first row or column
    if cover == "centre":
        spots = "array(named_struct('i', c + 0.5D, 'j', r + 0.5D))"
    elif cover == "extent":
        west, north = "(c - CASE WHEN c = 0 THEN 1.0D ELSE 0.0D END)", "(r - CASE WHEN r = 0 THEN 1.0D ELSE 0.0D END)"
        corners = [(i, j) for i in (west, "(c + 1.0D)") for j in (north, "(r + 1.0D)")]
        spots = "array(" + ", ".join(f"named_struct('i', {i}, 'j', {j})" for i, j in corners) + ")"
    else:
        raise ValueError("cover must be 'extent' or 'centre'")
    flat = f"transform({spots}, q -> named_struct('x', x0 + q.i * pixel_width, 'y', y0 - q.j * pixel_height))"
    back = geo.map_stages("_xy", geo.lonlat_stages("p.x", "p.y", "zone", "coalesce(south, false)"), {"x": "p.x", "y": "p.y"})
    placed = (
        grid.withColumn("_xy", F.expr(flat))
        .withColumn("_ll", F.expr(f"CASE WHEN coalesce(projected, false) THEN {back} END"))
        .selectExpr(
            "raster_id",
            "coalesce(transform(_ll, p -> p.lon), transform(_xy, p -> p.x)) AS lons",
            "coalesce(transform(_ll, p -> p.lat), transform(_xy, p -> p.y)) AS lats",
        )
    )
    boxed = placed.selectExpr(
        "raster_id", "array_min(lons) AS xmin", "array_min(lats) AS ymin", "array_max(lons) AS xmax", "array_max(lats) AS ymax"
    )
    xs, ys = _cells_of_box(cell)
    return (
        boxed.select("raster_id", F.explode(xs).alias("_cx"), ys.alias("_ys"))
        .select("raster_id", "_cx", F.explode("_ys").alias("_cy"))
        .select(
            "raster_id",
            (F.col("_cx").cast("long") * F.lit(1 << 32) + (F.col("_cy").cast("long") + F.lit(1 << 31))).alias("cell"),
        )
        .distinct()
    )


def cell_prefilter(
    buildings: DataFrame,
    cells: DataFrame,
    cell: float = 0.02,
    lon: str = "longitude",
    lat: str = "latitude",
) -> DataFrame:
    """Buildings standing in a wet cell (of any raster, or of their own ``raster_id``)."""
    keys = ["raster_id", "cell"] if "raster_id" in buildings.columns else ["cell"]
    placed = buildings.withColumn("cell", geo.cell_id(F.col(lon), F.col(lat), cell))
    return placed.join(cells.select(*keys), keys, "left_semi").select(*buildings.columns)


def remap_codes(
    pixels: DataFrame,
    feet: Mapping[int, float] = fixed.SURGE_CODE_FEET,
    nodata: float | None = None,
    unmapped: str = "nodata",
) -> DataFrame:
    """Replace category codes by heights; other codes become nodata or are dropped."""
    value = F.lit(None).cast("double")
    for code, height in feet.items():
        value = F.when(F.col("value") == float(code), F.lit(float(height))).otherwise(value)
    mapped = pixels.withColumn("value", value)
    if unmapped == "drop":
        return mapped.where(F.col("value").isNotNull())
    return mapped.fillna({"value": fixed.DEFAULT_NODATA if nodata is None else float(nodata)})


def raster_codes(pixels: DataFrame) -> DataFrame:
    """Distinct pixel values per raster with their counts, nodata included."""
    return pixels.groupBy("raster_id", "value").agg(F.count(F.lit(1)).alias("n_pixels"))
