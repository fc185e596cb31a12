"""Column arithmetic for grids, cells and the transverse Mercator projection.

The projection uses the WGS84 ellipsoid and the series of J. P. Snyder,
"Map Projections: A Working Manual", USGS Professional Paper 1395 (1987).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# WGS84 and UTM constants.
SEMI_MAJOR = 6378137.0
ECC2 = 0.00669438
SCALE = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING = 10000000.0

_EP2 = ECC2 / (1 - ECC2)


def pixel_index(offset: Column, size: Column) -> Column:
    """Grid index of an offset from the origin, truncated toward zero; NULL beyond any grid.

    Truncation maps points less than one pixel outside the origin edge to index 0.
    """
    return (offset / size).try_cast("int")


def cell_index(coordinate: Column, cell: float) -> Column:
    """Index of the coarse square cell holding a coordinate; NULL for what is no position."""
    return F.floor(coordinate / F.lit(float(cell))).try_cast("int")


def cell_id(lon: Column, lat: Column, cell: float) -> Column:
    """One 64-bit id of the coarse square cell holding a point."""
    return cell_code(cell_index(lon, cell), cell_index(lat, cell))


def cell_code(x: Column, y: Column) -> Column:
    """One 64-bit id of two cell indexes."""
    return x.cast("long") * F.lit(1 << 32) + (y.cast("long") + F.lit(1 << 31))


def utm_zone(lat: Column, lon: Column) -> Column:
    """UTM zone number, with the Norway and Svalbard exceptions."""
    x = F.pmod(lon + 180.0, F.lit(360.0)) - 180.0
    plain = (F.floor((x + 180.0) / 6.0) + 1).cast("int")
    svalbard = (lat >= 72) & (lat <= 84) & (x >= 0)
    return (
        F.when((lat >= 56) & (lat < 64) & (x >= 3) & (x < 12), F.lit(32))
        .when(svalbard & (x < 9), F.lit(31))
        .when(svalbard & (x < 21), F.lit(33))
        .when(svalbard & (x < 33), F.lit(35))
        .when(svalbard & (x < 42), F.lit(37))
        .otherwise(plain)
    )


# The series are long and share many terms, so they are SQL texts in stages: each stage
# names the terms the next one uses. A NULL longitude passes through every stage.
def utm_stages(lat: str, lon: str, zone: str) -> list[dict[str, str]]:
    """Stages from degrees to ``utm_x``, ``utm_y`` in metres (Snyder eqs. 8-9 to 8-15)."""
    e2, e4, e6 = ECC2, ECC2**2, ECC2**3
    arc = (
        f"{SEMI_MAJOR!r}D * ({1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256!r}D * u_phi"
        f" - {3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024!r}D * sin(2 * u_phi)"
        f" + {15 * e4 / 256 + 45 * e6 / 1024!r}D * sin(4 * u_phi)"
        f" - {35 * e6 / 3072!r}D * sin(6 * u_phi))"
    )
    return [
        {
            "u_phi": f"radians({lat})",
            # the longitude difference, within half a turn
            "u_delta": f"radians(pmod({lon} - ({zone} * 6.0D - 183.0D) + 180.0D, 360.0D) - 180.0D)",
        },
        {
            "u_n": f"{SEMI_MAJOR!r}D / sqrt(1 - {ECC2!r}D * sin(u_phi) * sin(u_phi))",
            "u_t": "tan(u_phi) * tan(u_phi)",
            "u_c": f"{_EP2!r}D * cos(u_phi) * cos(u_phi)",
            "u_a": "cos(u_phi) * u_delta",
            "u_m": arc,
        },
        {
            "utm_x": f"{SCALE!r}D * u_n * (u_a + pow(u_a, 3) / 6 * (1 - u_t + u_c) + pow(u_a, 5) / 120"
            f" * (5 - 18 * u_t + u_t * u_t + 72 * u_c - {58 * _EP2!r}D)) + {FALSE_EASTING!r}D",
            "utm_y": f"{SCALE!r}D * (u_m + u_n * tan(u_phi) * (pow(u_a, 2) / 2 + pow(u_a, 4) / 24"
            f" * (5 - u_t + 9 * u_c + 4 * u_c * u_c) + pow(u_a, 6) / 720 * (61 - 58 * u_t + u_t * u_t"
            f" + 600 * u_c - {330 * _EP2!r}D))) + CASE WHEN {lat} < 0 THEN {FALSE_NORTHING!r}D ELSE 0.0D END",
        },
    ]


def lonlat_stages(x: str, y: str, zone: str, south: str) -> list[dict[str, str]]:
    """Stages from metres to ``lon``, ``lat`` in degrees (Snyder eqs. 8-17 to 8-25)."""
    e2, e4, e6 = ECC2, ECC2**2, ECC2**3
    root = (1 - ECC2) ** 0.5
    e1 = (1 - root) / (1 + root)
    rectifying = SEMI_MAJOR * (1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256)
    return [
        {"v_mu": f"({y} - CASE WHEN {south} THEN {FALSE_NORTHING!r}D ELSE 0.0D END) / {SCALE * rectifying!r}D"},
        {
            "v_phi": f"v_mu + {3 * e1 / 2 - 27 * e1**3 / 32!r}D * sin(2 * v_mu)"
            f" + {21 * e1**2 / 16 - 55 * e1**4 / 32!r}D * sin(4 * v_mu)"
            f" + {151 * e1**3 / 96!r}D * sin(6 * v_mu) + {1097 * e1**4 / 512!r}D * sin(8 * v_mu)"
        },
        {
            "v_c": f"{_EP2!r}D * cos(v_phi) * cos(v_phi)",
            "v_t": "tan(v_phi) * tan(v_phi)",
            "v_w": f"1 - {ECC2!r}D * sin(v_phi) * sin(v_phi)",
        },
        {
            "v_d": f"({x} - {FALSE_EASTING!r}D) * sqrt(v_w) / {SEMI_MAJOR * SCALE!r}D",
            "v_q": f"tan(v_phi) * v_w / {1 - ECC2!r}D",
        },
        {
            "lat": "degrees(v_phi - v_q * (pow(v_d, 2) / 2 - pow(v_d, 4) / 24 * (5 + 3 * v_t + 10 * v_c - 4 * v_c * v_c"
            f" - {9 * _EP2!r}D) + pow(v_d, 6) / 720 * (61 + 90 * v_t + 298 * v_c + 45 * v_t * v_t"
            f" - {252 * _EP2!r}D - 3 * v_c * v_c)))",
            "lon": "degrees((v_d - pow(v_d, 3) / 6 * (1 + 2 * v_t + v_c) + pow(v_d, 5) / 120 * (5 - 2 * v_c + 28 * v_t"
            f" - 3 * v_c * v_c + {8 * _EP2!r}D + 24 * v_t * v_t)) / cos(v_phi)) + {zone} * 6.0D - 183.0D",
        },
    ]


# Fixed value: the least radius of curvature of the ellipsoid, that of the meridian at the equator.
LEAST_RADIUS = SEMI_MAJOR * (1 - ECC2)


def bend_degrees(step: str, east: str, north: str) -> dict[str, str]:
    """Most that ``lon`` and ``lat`` along a straight projected line leave the chord between points ``step`` metres apart.

    On the sphere, isometric latitude and longitude are arctanh(sin z) of the scaled place z, so
    their second derivatives are at most cosh(x) / cos(y)^2 in size; that of latitude gains half of
    1 / cos(y)^2. A chord is left by at most the square of the step times an eighth of that. ``east`` and ``north``
    are the largest distances from the central meridian and the equator. The least radius makes every term
    too large, and a tenth more covers the flattening.
    """
    unit = f"{SCALE * LEAST_RADIUS!r}D"
    flat = f"pow(cos(least({north} / {unit}, 1.57D)), 2)"
    arc = f"1.1D * degrees(pow({step} / {unit}, 2) / 8)"
    return {
        "lon": f"({arc} * cosh({east} / {unit}) / {flat} + 1e-9D)",
        "lat": f"({arc} * (cosh({east} / {unit}) + 0.5D) / {flat} + 1e-9D)",
    }


def add_stages(df: DataFrame, stages: list[dict[str, str]]) -> DataFrame:
    """Add the columns of the last stage; earlier stages are dropped again."""
    out = df
    for stage in stages:
        out = out.withColumns({name: F.expr(text) for name, text in stage.items()})
    return out.drop(*[name for stage in stages[:-1] for name in stage])


def map_stages(array: str, stages: list[dict[str, str]], keep: dict[str, str]) -> str:
    """The same over an array of structs ``p``; ``keep`` names what every stage passes on."""
    text = array
    names: dict[str, str] = dict(keep)
    for stage in stages:
        fields = ", ".join(f"'{n}', {e}" for n, e in {**names, **{k: _of_p(v) for k, v in stage.items()}}.items())
        text = f"transform({text}, p -> named_struct({fields}))"
        names.update({k: f"p.{k}" for k in stage})
    return text


def _of_p(text: str) -> str:
    """Stage terms read from the struct."""
    return re.sub(r"\b(v_[a-z]+)\b", r"p.\1", text)


def crosses_left_of(px: Column, py: Column, e: Column) -> Column:
    """True when edge ``e`` crosses the leftward horizontal ray from ``(px, py)``.

    An end at the height of the ray counts as below it, and a crossing at ``px`` itself as not left.
    """
    spans = (e["y1"] > py) != (e["y2"] > py)
    return spans & _left(px, py, e)


def _side(px: Column, py: Column, e: Column) -> Column:
    return (px - e["x1"]) * (e["y2"] - e["y1"]) - (e["x2"] - e["x1"]) * (py - e["y1"])


def _left(px: Column, py: Column, e: Column) -> Column:
    """Of an edge that spans the height ``py``: whether it passes left of ``px``. Rounding plays no part
    unless the edge spans ``px`` too."""
    side = _side(px, py, e)
    west = e["x1"] < px
    return F.when(west == (e["x2"] < px), west).otherwise(F.when(e["y2"] > e["y1"], side > 0).otherwise(side < 0))


def _below(px: Column, py: Column, e: Column) -> Column:
    """Of an edge that spans ``px``: whether it passes below ``py``. The same sign as in :func:`_left`
    decides, so the two never contradict each other."""
    side = _side(px, py, e)
    low = ~(e["y1"] > py)
    # on the edge itself: as _left has it
    sign = F.when(side != 0, side < 0).otherwise(e["y2"] > e["y1"])
    return F.when(low == ~(e["y2"] > py), low).otherwise(sign == (e["x2"] > e["x1"]))


def crosses_path(px: Column, py: Column, cx: Column, cy: Column, e: Column) -> Column:
    """True when edge ``e`` crosses the path from ``(cx, cy)`` up or down to the height ``py`` and then across to
    ``(px, py)`` an odd number of times.

    Over closed rings, the edges for which this holds are odd in number exactly where one of the two
    places is inside by :func:`crosses_left_of` and the other is not, rounding included.
    """
    up = ((e["x1"] < cx) != (e["x2"] < cx)) & (_below(cx, py, e) != _below(cx, cy, e))
    across = ((e["y1"] > py) != (e["y2"] > py)) & (_left(px, py, e) != _left(cx, py, e))
    return up != across


def edge_meets_box(x1, y1, x2, y2, xmin, ymin, xmax, ymax) -> Column:
    """True when a segment has a point in a closed rectangle."""
    near = (
        (F.least(x1, x2) <= xmax)
        & (F.greatest(x1, x2) >= xmin)
        & (F.least(y1, y2) <= ymax)
        & (F.greatest(y1, y2) >= ymin)
    )
    dx, dy = x2 - x1, y2 - y1
    corners = [dx * (cy - y1) - dy * (cx - x1) for cx in (xmin, xmax) for cy in (ymin, ymax)]
    return near & (F.least(*corners) <= 0) & (F.greatest(*corners) >= 0)
