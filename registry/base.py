"""Query registry, and the projections of the given tables that queries start from.

Row-wise projections are written once as SQL expressions that mean the same in Spark
and in the check database; everything after them is written twice.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import fixed
from tidemark.operators.curves import Lookups

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def project(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {n}" for n, e in exprs.items()])


def select(exprs: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in exprs.items()) + f" FROM {source}"


# --- inventory from lineitem -------------------------------------------------------
BLDG = {
    "bid": "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING))",
    "occtype": "CASE l_partkey % 10 WHEN 0 THEN 'RES1-1SNB' WHEN 1 THEN 'RES1-2SWB' WHEN 2 THEN 'res3a' "
    "WHEN 3 THEN 'RES2' WHEN 4 THEN 'COM1-X' WHEN 5 THEN 'RES4' WHEN 6 THEN 'REL1' "
    "WHEN 7 THEN 'COM6' WHEN 8 THEN 'RES1-SL' ELSE NULL END",
    "val_struct": "l_extendedprice",
    "sqft": "l_quantity * 100",
    "num_story": "CAST(l_linenumber AS DOUBLE) + CASE WHEN l_partkey % 10 = 8 THEN CAST('0.5' AS DOUBLE) "
    "ELSE CAST(0 AS DOUBLE) END",
    "found_type": "CASE l_suppkey % 6 WHEN 0 THEN 'S' WHEN 1 THEN ' crawl ' WHEN 2 THEN 'Basement' "
    "WHEN 3 THEN 'pier/pile' WHEN 4 THEN 'zzz' ELSE 'I' END",
    "found_ht": "CAST(l_suppkey % 9 AS DOUBLE) / CAST(2 AS DOUBLE)",
    "val_cont": "CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_extendedprice / CAST(2 AS DOUBLE) END",
    "longitude": "CAST(l_partkey % 220 AS DOUBLE) / CAST(100 AS DOUBLE) - CAST(82 AS DOUBLE) + CAST('0.005' AS DOUBLE)",
    "latitude": "CAST(l_suppkey % 100 AS DOUBLE) / CAST(100 AS DOUBLE) + CAST(27 AS DOUBLE) + CAST('0.005' AS DOUBLE)",
    "cbfips": "CASE WHEN l_linenumber = 7 THEN NULL ELSE concat(CASE WHEN l_linenumber % 2 = 0 THEN '1' ELSE '12' END, "
    "lpad(CAST(l_suppkey % 30 AS STRING), 3, '0'), lpad(CAST(l_partkey % 50 AS STRING), 6, '0'), '1001') END",
    "state": "CASE l_suppkey % 4 WHEN 0 THEN 'Florida' WHEN 1 THEN 'Georgia' WHEN 2 THEN 'South Carolina' ELSE 'Texas' END",
    "ground_elv": "CAST(l_partkey % 13 AS DOUBLE) / CAST(2 AS DOUBLE)",
    "pop2amu65": "CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_quantity AS BIGINT) ELSE 0 END",
    "pop2amo65": "CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_quantity AS BIGINT) ELSE 0 END",
    "pop2pmu65": "CASE WHEN l_linenumber % 3 = 0 THEN CAST(l_quantity AS BIGINT) ELSE 0 END",
    "pop2pmo65": "CASE WHEN l_linenumber % 3 = 1 THEN CAST(l_quantity AS BIGINT) ELSE 0 END",
    # a stand-in for a sampled depth, for queries that need no raster
    "depth": "CAST((l_partkey * 7 + l_suppkey * 3 + l_linenumber) % 60 AS DOUBLE) / CAST(4 AS DOUBLE) - CAST(2 AS DOUBLE)",
    "event": "concat('EVENT_', l_returnflag)",
    "adv": "CAST(10 + l_linenumber % 3 AS INT)",
    "user_curve": "CASE l_partkey % 5 WHEN 0 THEN '901' WHEN 1 THEN '902.0' WHEN 2 THEN '999' WHEN 3 THEN '' ELSE NULL END",
}


def bldg(spark: SparkSession, sf: str) -> DataFrame:
    return project(table(spark, sf, "lineitem"), BLDG)


# --- rasters from orders -----------------------------------------------------------
PIXEL_KEYS = {
    "raster_id": "concat('STORM', o_orderstatus, '_2024_adv', CASE WHEN substring(o_orderpriority, 1, 1) IN ('1', '2') "
    "THEN '11' ELSE '12' END, '_e10_ResultMaskRaster.tif')",
    "r": "CAST(o_custkey % 40 AS INT)",
    "c": "CAST(o_orderkey % 100 AS INT)",
    "w": "o_orderkey * 7 + o_custkey * 3",
}
PIXEL_VALUE = (
    "CASE WHEN (r + c) % 17 = 0 THEN CAST(-9999 AS DOUBLE) "
    "ELSE CAST(CAST(w AS BIGINT) % 60 AS DOUBLE) / CAST(4 AS DOUBLE) - CAST(2 AS DOUBLE) END"
)
META = {
    "raster_id": "raster_id",
    "x0": "CASE substring(raster_id, 6, 1) WHEN 'F' THEN CAST('-81.9' AS DOUBLE) WHEN 'O' THEN CAST('-81.8' AS DOUBLE) "
    "ELSE CAST('-81.7' AS DOUBLE) END",
    "y0": "CAST('27.8' AS DOUBLE)",
    "pixel_width": "CAST('0.02' AS DOUBLE)",
    "pixel_height": "CAST('0.02' AS DOUBLE)",
    "n_cols": "100",
    "n_rows": "40",
    "nodata": "CAST(-9999 AS DOUBLE)",
}


def pixels(spark: SparkSession, sf: str, keys: dict[str, str] = PIXEL_KEYS) -> DataFrame:
    keyed = project(table(spark, sf, "orders"), keys)
    summed = keyed.groupBy("raster_id", "r", "c").agg(F.sum("w").alias("w"))
    return summed.selectExpr("raster_id", "r", "c", f"{PIXEL_VALUE} AS value")


def meta(spark: SparkSession, sf: str, keys: dict[str, str] = PIXEL_KEYS, places: dict[str, str] = META) -> DataFrame:
    ids = project(table(spark, sf, "orders"), keys).select("raster_id").distinct()
    return project(ids, places).withColumns(
        {
            "projected": F.lit(False),
            "zone": F.lit(None).cast("int"),
            "south": F.lit(False),
        }
    )


# --- forty storms, each over a tenfold degree of its own ------------------------------
FAR_I, FAR_J = "l_orderkey % 8", "l_suppkey % 5"
FAR_BLDG = {
    **BLDG,
    "longitude": f"{BLDG['longitude']} + CAST({FAR_I} AS DOUBLE) * CAST(12 AS DOUBLE)",
    "latitude": f"{BLDG['latitude']} - CAST({FAR_J} AS DOUBLE) * CAST(12 AS DOUBLE)",
}
FAR_KEYS = {
    **PIXEL_KEYS,
    "raster_id": "concat('FAR', CAST(o_orderkey % 8 AS STRING), CAST(o_custkey % 5 AS STRING), '_2024_adv11_e10_ResultMaskRaster.tif')",
    "c": "CAST(floor(CAST(o_orderkey AS DOUBLE) / CAST(8 AS DOUBLE)) AS INT) % 100",
}
FAR_META = {
    **META,
    "x0": "CAST('-81.9' AS DOUBLE) + CAST(substring(raster_id, 4, 1) AS DOUBLE) * CAST(12 AS DOUBLE)",
    "y0": "CAST('27.8' AS DOUBLE) - CAST(substring(raster_id, 5, 1) AS DOUBLE) * CAST(12 AS DOUBLE)",
}


def far_bldg(spark: SparkSession, sf: str) -> DataFrame:
    return project(table(spark, sf, "lineitem"), FAR_BLDG)


def far_pixels(spark: SparkSession, sf: str) -> DataFrame:
    return pixels(spark, sf, FAR_KEYS)


def far_meta(spark: SparkSession, sf: str) -> DataFrame:
    return meta(spark, sf, FAR_KEYS, FAR_META)


# --- projected rasters in zone 17, under buildings on both sides of its border ----------
UTM_BLDG = {**BLDG, "longitude": f"{BLDG['longitude']} + CAST('2.5' AS DOUBLE)"}
UTM_META = {
    **META,
    "x0": "CASE substring(raster_id, 6, 1) WHEN 'F' THEN CAST(650000 AS DOUBLE) WHEN 'O' THEN CAST(662000 AS DOUBLE) ELSE CAST(674000 AS DOUBLE) END",
    "y0": "CAST(3093000 AS DOUBLE)",
    "pixel_width": "CAST(1800 AS DOUBLE)",
    "pixel_height": "CAST(2500 AS DOUBLE)",
}
UTM_ZONE = 17


def utm_bldg(spark: SparkSession, sf: str) -> DataFrame:
    return project(table(spark, sf, "lineitem"), UTM_BLDG)


def utm_meta(spark: SparkSession, sf: str) -> DataFrame:
    return meta(spark, sf, places=UTM_META).withColumns({"projected": F.lit(True), "zone": F.lit(UTM_ZONE)})


# --- lookups: made-up curves and rates, stated by a rule ---------------------------
SOIDS = (
    [f"R1{m}{s}" for m in ("1", "2", "3", "S") for s in "NB"]
    + [f"R3A{m}{s}" for m in "135" for s in "NB"]
    + [f"R21{s}" for s in "NB"]
    + [f"{p}{m}{s}" for p in ("C1", "C6", "R4", "RE1") for m in "LMH" for s in "NB" if p + m + s != "R4HN"]
)
CURVE_SETS = [
    ("building", "riverine", 4.0),
    ("building", "coastal_a", 6.0),
    ("building", "coastal_v", 8.0),
    ("content", "riverine", 3.0),
    ("content", "coastal_a", 5.0),
    ("content", "coastal_v", 7.0),
    ("inventory", "riverine", 2.0),
]


def curve_rows() -> list[tuple]:
    """``(kind, zone, soid, ddf_id, slope)``: percent per foot above the lowest depth."""
    rows = []
    for n, (kind, zone, slope) in enumerate(CURVE_SETS):
        for k, soid in enumerate(SOIDS):
            residential = soid[0] == "R" and not soid.startswith("RE1")
            if zone != "riverine" and not residential:
                continue
            rows.append((kind, zone, soid, str(100 * (n + 1) + k), slope + 0.25 * (k % 5)))
    return rows


LIBRARY_ROWS = [
    (kind, ddf, occ, slope)
    for kind, add in (("building", 0.0), ("content", 0.5), ("inventory", 1.0))
    for ddf, occ, slope in (("901", "RES1", 10.0 + add), ("902", "COM1", 12.0 + add))
]
OCCUPANCIES = ["RES1", "RES2", "RES3A", "RES4", "COM1", "COM6", "REL1"]
DEBRIS_ROWS = [
    (f"{o}{b}{f}{s}", 0.5 * i + 1 + n, 2.0 * n + i, 1.5 * i)
    for i, o in enumerate(OCCUPANCIES)
    for b in ("NB", "B")
    for f in ("SG", "FT")
    for n, s in enumerate(("0", "1", "4", "6", "8", "12"))
    if o != "REL1"
]
RESTORATION_ROWS = [
    (f"{o}{s}", 30 * (n + 1) + i, 90 * (n + 1) + i)
    for i, o in enumerate(OCCUPANCIES)
    for n, s in enumerate(("1", "4", "8", "12", "24"))
    if f"{o}{s}" != "COM624"
]
SALES_ROWS = [("COM1", 53.0, 13.0), ("COM2", 77.0, 10.0), ("AGR1", 148.0, 8.0)]


def slope_curve(slope: str) -> str:
    """Curve points of a slope: 29 steps, one per foot, from 0 up to 100 percent."""
    return f"transform(sequence(0, 28), i -> least(100.0D, greatest(0.0D, (i - 4) * {slope})))"


def literal_rows(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A literal table inside the plan; no Python rows are shipped at run time."""
    return spark.sql(values(rows, names))


def lookups(spark: SparkSession) -> Lookups:
    curve = f"{slope_curve('slope')} AS curve"
    curves = literal_rows(spark, [(*r, i) for i, r in enumerate(curve_rows())], "kind, zone, key, ddf_id, slope, pos")
    library = literal_rows(spark, [(*r, i) for i, r in enumerate(LIBRARY_ROWS)], "kind, ddf_id, occupancy, slope, pos")
    return Lookups(
        curves=curves.selectExpr("kind", "zone", "key", "ddf_id", curve, "pos"),
        library=library.selectExpr("kind", "ddf_id", "occupancy", curve, "pos"),
        debris=literal_rows(spark, DEBRIS_ROWS, "DebrisID, Finishes, Structure, Foundation"),
        restoration=literal_rows(spark, RESTORATION_ROWS, "RestFnID, Min_Restor_Days, Max_Restor_Days"),
        sales=literal_rows(spark, SALES_ROWS, "Occupancy, AnnualSalesPerSqFt, BusinessInvPctofSales"),
    )


def loaded_lookups(spark: SparkSession, root: str) -> Lookups:
    """The same tables written as the files a user has, and read by the loaders."""
    from tidemark.sources.lookups import load_lookups

    made = lookups(spark)
    points = [F.element_at("curve", i + 1).alias(c) for i, c in enumerate(fixed.CURVE_COLUMNS)]

    def save(df: DataFrame, name: str) -> str:
        df.coalesce(1).write.option("header", True).option("escape", '"').csv(f"{root}/{name}")
        return f"{root}/{name}"

    note = [F.lit("made up").alias("Source"), F.lit('text, with "comma"').alias("Description")]
    curves = {}
    for kind, zone, _ in CURVE_SETS:
        rows = made.curves.where((F.col("kind") == kind) & (F.col("zone") == zone)).orderBy("pos")
        named = rows.select(F.substring("key", 1, 2).alias("Occupancy"), F.concat(F.lit(" "), "key").alias("SpecificOccupId"), *note, *points, F.col("ddf_id").alias("DDF_ID"))
        curves[kind, zone] = save(named, f"{kind}_{zone}.csv")
    library = {}
    for kind in ("building", "content", "inventory"):
        rows = made.library.where(F.col("kind") == kind).orderBy("pos")
        library[kind] = (save(rows.select("Occupancy", F.col("ddf_id").alias("DmgFnId"), *note, *points), f"{kind}_library.csv"), "DmgFnId")
    debris = save(made.debris.withColumns({"Description": F.lit("x"), "Comment": F.lit(None).cast("string")}), "debris.csv")
    blank = {c: F.lit(0) for c in ("Min_Depth", "Max_Depth")}
    restoration = save(made.restoration.withColumns({**blank, "Occupancy": F.lit("")}), "restoration.csv")
    sales = save(made.sales.withColumn("OccupancyPlaceholder", F.lit("")), "sales.csv")
    return load_lookups(spark, curves, debris, restoration, sales, library)


# --- census and boundary tables ----------------------------------------------------
SVI_KEYS = {
    "FIPS": "concat(CASE WHEN c_nationkey % 2 = 0 THEN '12' ELSE '01' END, lpad(CAST(c_nationkey AS STRING), 3, '0'))",
    "ST_ABBR": "CASE WHEN c_nationkey % 2 = 0 THEN 'FL' ELSE 'AL' END",
    "COUNTY": "concat('County ', CAST(c_nationkey AS STRING))",
    "k": "CAST(c_nationkey AS DOUBLE)",
}
EP_COLUMNS = [c for c in fixed.SVI_COLUMNS if c.startswith("EP_")]
SVI_VALUES = {c: f"k + CAST({i} AS DOUBLE)" for i, c in enumerate(EP_COLUMNS)}


def svi(spark: SparkSession, sf: str) -> DataFrame:
    keyed = project(table(spark, sf, "customer"), SVI_KEYS)
    counted = keyed.groupBy("FIPS", "ST_ABBR", "COUNTY", "k").agg(F.count(F.lit(1)).alias("n"))
    return counted.selectExpr(
        "ST_ABBR", "COUNTY", "FIPS", "CAST(n * 100 AS DOUBLE) AS E_TOTPOP", *[f"{e} AS {c}" for c, e in SVI_VALUES.items()]
    )


# five by five boxes over the area of the buildings, one per nation
BOX = {
    "geo_id": "lpad(CAST(n_nationkey AS STRING), 2, '0')",
    "NAME": "n_name",
    "bx1": "CAST(n_nationkey % 5 AS DOUBLE) * CAST('0.5' AS DOUBLE) - CAST(82 AS DOUBLE)",
    "by1": "floor(CAST(n_nationkey AS DOUBLE) / CAST(5 AS DOUBLE)) * CAST('0.25' AS DOUBLE) + CAST(27 AS DOUBLE)",
}


def boxes(spark: SparkSession, sf: str) -> DataFrame:
    base = project(table(spark, sf, "nation"), BOX)
    return base.selectExpr("geo_id", "NAME", "bx1", "by1", "bx1 + 0.375D AS bx2", "by1 + 0.25D AS by2")


def box_edges(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.operators.boundaries import polygon_edges

    def at(x, y):
        return F.struct(F.col(x).alias("x"), F.col(y).alias("y"))

    ring = F.array(at("bx1", "by1"), at("bx2", "by1"), at("bx2", "by2"), at("bx1", "by2"))
    return polygon_edges(boxes(spark, sf).select("geo_id", F.lit(0).alias("ring"), ring.alias("points")))


# --- check database side -----------------------------------------------------------
def values(rows: list[tuple], names: str) -> str:
    def lit(v):
        if isinstance(v, float):
            return f"CAST({v} AS DOUBLE)"
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({names})"


CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, text: str, *needs: str) -> None:
    CTES[name] = (list(needs), text)


def sql(body: str, *needs: str) -> str:
    """``body`` after the named common table expressions and what they need."""
    order: list[str] = []

    def visit(name: str) -> None:
        for n in CTES[name][0]:
            visit(n)
        if name not in order:
            order.append(name)

    for n in needs:
        visit(n)
    parts = ", ".join(f"{n} AS ({CTES[n][1]})" for n in order)
    return f"WITH {parts} {body}" if parts else body


cte("bldg", select(BLDG, "lineitem"))
cte("pixel_keys", select(PIXEL_KEYS, "orders"))
cte(
    "pixels",
    f"SELECT raster_id, r, c, {PIXEL_VALUE} AS value FROM "
    "(SELECT raster_id, r, c, sum(w) AS w FROM pixel_keys GROUP BY 1, 2, 3)",
    "pixel_keys",
)
cte("meta", select(META, "(SELECT DISTINCT raster_id FROM pixel_keys)"), "pixel_keys")
cte(
    "bounds",
    "SELECT *, x0 AS xmin, y0 - pixel_height * n_rows AS ymin, x0 + pixel_width * n_cols AS xmax, y0 AS ymax FROM meta",
    "meta",
)
cte("curves", values(curve_rows(), "kind, zone, soid, ddf_id, slope"))
cte("library", values(LIBRARY_ROWS, "kind, ddf_id, occupancy, slope"))
cte("debris", values(DEBRIS_ROWS, "DebrisID, Finishes, Structure, Foundation"))
cte("restoration", values(RESTORATION_ROWS, "RestFnID, lo_days, hi_days"))
cte("sales", values(SALES_ROWS, "Occupancy, per_sqft, pct"))
cte("svi_keys", select(SVI_KEYS, "customer"))
cte(
    "svi",
    "SELECT ST_ABBR, COUNTY, FIPS, CAST(n * 100 AS DOUBLE) AS E_TOTPOP, "
    + ", ".join(f"{e} AS {c}" for c, e in SVI_VALUES.items())
    + " FROM (SELECT FIPS, ST_ABBR, COUNTY, k, count(*) AS n FROM svi_keys GROUP BY ALL)",
    "svi_keys",
)
cte(
    "boxes",
    "SELECT *, bx1 + CAST('0.375' AS DOUBLE) AS bx2, by1 + CAST('0.25' AS DOUBLE) AS by2 FROM ("
    + select(BOX, "nation")
    + ")",
)
OCC = "upper(split_part(occtype, '-', 1))"
FOUNDATION = (
    "CASE WHEN upper(trim(found_type)) IN ('C','CRAWL','CRAWLSPACE','CRAWL SPACE','5','F','I','W') THEN 5 "
    "WHEN upper(trim(found_type)) IN ('B','BASEMENT','4') THEN 4 "
    "WHEN upper(trim(found_type)) IN ('P','PIER','PILE','PILES','PIER/PILE','2') THEN 2 ELSE 7 END"
)
STRICT = " AND ".join(f"{c} IS NOT NULL" for c in fixed.STRICT_REQUIRED_COLUMNS)
ENGINE = (
    f"bid AS FltyId, {OCC} AS Occ, val_struct AS Cost, sqft AS Area, num_story AS NumStories, "
    f"{FOUNDATION} AS FoundationType, found_ht AS FirstFloorHt, coalesce(val_cont, 0) AS ContentCost, "
    "latitude AS Latitude, longitude AS Longitude"
)
# ties of the de-duplication: all other used columns, in the order they are carried
TIES = (
    "occtype NULLS FIRST, sqft NULLS FIRST, num_story NULLS FIRST, found_type NULLS FIRST, found_ht NULLS FIRST, "
    "latitude NULLS FIRST, longitude NULLS FIRST, val_cont NULLS FIRST, cbfips NULLS FIRST, state NULLS FIRST"
)
cte(
    "clipped",
    f"SELECT {ENGINE}, raster_id, cbfips, state FROM (SELECT b.*, m.raster_id, row_number() OVER (PARTITION BY m.raster_id, bid "
    f"ORDER BY val_struct DESC NULLS LAST, {TIES}) AS rn FROM bldg b JOIN bounds m ON latitude BETWEEN ymin AND ymax "
    f"AND longitude BETWEEN xmin AND xmax WHERE {STRICT}) WHERE rn = 1",
    "bldg",
    "bounds",
)
cte(
    "sampled",
    "SELECT e.*, CASE WHEN e.r >= 0 AND e.r < n_rows AND e.c >= 0 AND e.c < n_cols AND p.value IS NOT NULL "
    "AND p.value <> nodata THEN p.value ELSE CAST(0 AS DOUBLE) END AS depth_grid FROM ("
    "SELECT k.*, m.nodata, m.n_rows, m.n_cols, trunc((Longitude - x0) / pixel_width) AS c, "
    "trunc((y0 - Latitude) / pixel_height) AS r FROM clipped k JOIN meta m USING (raster_id)) e "
    "LEFT JOIN pixels p ON p.raster_id = e.raster_id AND p.r = e.r AND p.c = e.c",
    "clipped",
    "meta",
    "pixels",
)
# strict engine rows with the stand-in depth, no raster, repeats kept
cte(
    "exposure",
    f"SELECT {ENGINE}, 'stand-in' AS raster_id, cbfips, state, depth AS depth_grid, user_curve FROM bldg WHERE {STRICT}",
    "bldg",
)
SOID_SQL = (
    "concat(CASE WHEN Occ = 'REL1' THEN 'RE1' ELSE concat(substr(Occ, 1, 1), CASE WHEN length(Occ) > 3 THEN substr(Occ, 4) "
    "WHEN length(Occ) = 3 THEN Occ WHEN length(Occ) = 2 THEN substr(Occ, 2) ELSE '' END) END, "
    "CASE WHEN substr(Occ, 1, 4) = 'RES3' THEN CASE WHEN NumStories > 4 THEN '5' WHEN NumStories > 2 THEN '3' ELSE '1' END "
    "WHEN substr(Occ, 1, 4) = 'RES1' THEN CASE WHEN NumStories > 3 THEN '3' WHEN NumStories = round_even(NumStories, 0) "
    "THEN CAST(CAST(NumStories AS INT) AS VARCHAR) ELSE 'S' END WHEN substr(Occ, 1, 4) = 'RES2' THEN '1' "
    "ELSE CASE WHEN NumStories > 6 THEN 'H' WHEN NumStories > 3 THEN 'M' ELSE 'L' END END, "
    "CASE WHEN FoundationType = 4 THEN 'B' ELSE 'N' END)"
)
DEBRIS_SQL = (
    "CASE WHEN d > 0 THEN concat(Occ, CASE WHEN Occ = 'RES1' AND FoundationType = 4 THEN 'B' ELSE 'NB' END, "
    "CASE WHEN FoundationType IN (4, 7) THEN 'SG' ELSE 'FT' END, "
    "CASE WHEN Occ IN ('RES1', 'COM6') AND FoundationType = 4 THEN "
    "CASE WHEN d < 4 THEN '0' WHEN d < 6 THEN '4' WHEN d < 8 THEN '6' ELSE '8' END ELSE "
    "CASE WHEN d < 1 THEN '0' WHEN d < 4 THEN '1' WHEN d < 8 THEN '4' WHEN d < 12 THEN '8' ELSE '12' END END) END"
)
RESTORE_SQL = (
    "CASE WHEN d > 0 THEN concat(Occ, CASE WHEN d < 1 THEN '1' WHEN d < 4 THEN '4' WHEN d < 8 THEN '8' "
    "WHEN d < 12 THEN '12' ELSE '24' END) END"
)


def point_sql(slope: str, at: str) -> str:
    return f"least(CAST(100 AS DOUBLE), greatest(CAST(0 AS DOUBLE), {at} * {slope}))"


def ratio_sql(slope: str) -> str:
    low, high = point_sql(slope, "floor(d)"), point_sql(slope, "ceil(d)")
    return f"(({low} + (d - floor(d)) * ({high} - {low})) / 100)"


def damage_sql(source: str, flood_code: str, override: bool) -> dict[str, tuple[list[str], str]]:
    """CTE chain from engine rows with depth to full results named ``res_<source>``."""
    user = "user_curve" if override else "CAST(NULL AS VARCHAR)"
    uid = f"nullif(regexp_replace({user}, '[.]0+$', ''), '')"
    keyed = (
        f"SELECT s.*, depth_grid - FirstFloorHt AS din, CASE WHEN depth_grid - FirstFloorHt > 24 THEN 24 "
        f"WHEN depth_grid - FirstFloorHt < -4 THEN -4 ELSE depth_grid - FirstFloorHt END AS d, {SOID_SQL} AS soid, "
        f"CASE WHEN substr(Occ, 1, 3) = 'RES' AND '{flood_code}' = 'CAE' THEN 'coastal_a' "
        f"WHEN substr(Occ, 1, 3) = 'RES' AND '{flood_code}' IN ('V', 'VE') THEN 'coastal_v' ELSE 'riverine' END AS zone, "
        f"{uid} AS uid FROM {source} s"
    )
    stocked = "Occ IN ('COM1','COM2','IND1','IND2','IND3','IND4','IND5','IND6','AGR1')"
    lib = "SELECT * FROM library" if override else "SELECT * FROM library WHERE false"
    joined = (
        f"SELECT k.*, {stocked} AS stocked, coalesce(ub.ddf_id, cb.ddf_id) AS b_id, coalesce(ub.slope, cb.slope) AS b_s, "
        f"coalesce(uk.ddf_id, ck.ddf_id) AS k_id, coalesce(uk.slope, ck.slope) AS k_s, "
        f"coalesce(ui.ddf_id, CASE WHEN {stocked} THEN ci.ddf_id ELSE '0' END) AS i_id, "
        f"coalesce(ui.slope, CASE WHEN {stocked} THEN ci.slope ELSE CAST(0 AS DOUBLE) END) AS i_s, "
        "x.DebrisID AS hit_debris, x.Finishes, x.Structure, x.Foundation, y.RestFnID AS hit_rest, y.lo_days, y.hi_days, "
        f"CASE WHEN {stocked} THEN coalesce(z.per_sqft * z.pct * Area / 100, 0) ELSE 0 END AS stock, "
        f"{DEBRIS_SQL} AS dkey, {RESTORE_SQL} AS rkey FROM keyed_{source} k "
        "LEFT JOIN curves cb ON cb.kind = 'building' AND cb.zone = k.zone AND cb.soid = k.soid "
        "LEFT JOIN curves ck ON ck.kind = 'content' AND ck.zone = k.zone AND ck.soid = k.soid "
        "LEFT JOIN curves ci ON ci.kind = 'inventory' AND ci.zone = k.zone AND ci.soid = k.soid "
        f"LEFT JOIN ({lib}) ub ON ub.kind = 'building' AND ub.ddf_id = k.uid "
        f"LEFT JOIN ({lib}) uk ON uk.kind = 'content' AND uk.ddf_id = k.uid "
        f"LEFT JOIN ({lib}) ui ON ui.kind = 'inventory' AND ui.ddf_id = k.uid "
        f"LEFT JOIN debris x ON x.DebrisID = {DEBRIS_SQL} LEFT JOIN restoration y ON y.RestFnID = {RESTORE_SQL} "
        "LEFT JOIN sales z ON z.Occupancy = k.Occ"
    )
    status = (
        "CASE WHEN depth_grid <= 0 THEN 'not_exposed' WHEN b_s IS NULL THEN 'unmatched' "
        "WHEN k_s IS NULL OR i_s IS NULL OR (dkey IS NOT NULL AND hit_debris IS NULL) "
        "OR (rkey IS NOT NULL AND hit_rest IS NULL) THEN 'row_error' ELSE 'ok' END"
    )
    cost = "CAST(trunc(Cost) AS DOUBLE)"
    content = "CAST(trunc(ContentCost) AS DOUBLE)"

    def hit(expr: str, dry: str) -> str:
        return f"CASE WHEN status = 'not_exposed' THEN {dry} WHEN status IN ('ok', 'row_error') THEN {expr} END"

    def tons(expr: str) -> str:
        return f"CASE WHEN status IN ('ok', 'row_error') AND d > 0 THEN {expr} END"

    parts = [f"Area * {c} / 1000" for c in ("Finishes", "Structure", "Foundation")]
    days = [
        f"CASE WHEN status = 'not_exposed' THEN 0 WHEN status IN ('ok', 'row_error') AND d > 0 THEN {c} "
        "WHEN status IN ('ok', 'row_error') THEN 0 END"
        for c in ("lo_days", "hi_days")
    ]
    result = (
        "SELECT FltyId, Occ, Cost, Area, NumStories, FoundationType, FirstFloorHt, ContentCost, Latitude, Longitude, cbfips, state, "
        "depth_grid AS Depth_Grid, din AS Depth_in_Struc, CASE WHEN depth_grid > 0 THEN 1 ELSE 0 END AS flExp, soid AS SOID, "
        f"CASE WHEN status = 'unmatched' THEN 'Unmatched' ELSE {hit('b_id', chr(39) + '0' + chr(39))} END AS BDDF_ID, "
        f"{hit(ratio_sql('b_s') + ' * 100', '0')} AS BldgDmgPct, {hit(ratio_sql('b_s') + ' * ' + cost, '0')} AS BldgLossUSD, "
        f"{content} AS ContentCostUSD, {hit('k_id', chr(39) + '0' + chr(39))} AS CDDF_ID, "
        f"{hit(ratio_sql('k_s') + ' * 100', '0')} AS ContDmgPct, {hit(ratio_sql('k_s') + ' * ' + content, '0')} AS ContentLossUSD, "
        f"stock AS InventoryCostUSD, {hit('i_id', chr(39) + '0' + chr(39))} AS IDDF_ID, "
        f"{hit(ratio_sql('i_s') + ' * 100', '0')} AS InvDmgPct, {hit(ratio_sql('i_s') + ' * stock', '0')} AS InventoryLossUSD, "
        f"CASE WHEN status = 'not_exposed' THEN '' ELSE {tons('dkey')} END AS DebrisID, "
        f"{tons(parts[0])} AS Debris_Fin, {tons(parts[1])} AS Debris_Struc, {tons(parts[2])} AS Debris_Found, "
        f"{tons(' + '.join(parts))} AS Debris_Tot, {days[0]} AS Restor_Days_Min, {days[1]} AS Restor_Days_Max, "
        f"raster_id AS GridName, status, uid FROM (SELECT *, {status} AS status FROM joined_{source})"
    )
    return {
        f"keyed_{source}": ([source], keyed),
        f"joined_{source}": ([f"keyed_{source}", "curves", "library", "debris", "restoration", "sales"], joined),
        f"res_{source}": ([f"joined_{source}"], result),
    }


CTES.update(damage_sql("sampled", "CAE", False))


# transverse Mercator from the published series, both ways, as nested selects over ``source``
_A, _K, _E2 = "6378137e0", "9996e-4", 0.00669438
_EP = f"{_E2 / (1 - _E2):.17e}"


def forward_sql(source: str, lat: str, lon: str, zone: str) -> str:
    """``source`` with columns ``utm_x`` and ``utm_y`` in metres, north of the equator."""
    arc = (1 - _E2 / 4 - 3 * _E2**2 / 64 - 5 * _E2**3 / 256, 3 * _E2 / 8 + 3 * _E2**2 / 32 + 45 * _E2**3 / 1024, 15 * _E2**2 / 256 + 45 * _E2**3 / 1024, 35 * _E2**3 / 3072)
    m0, m2, m4, m6 = (f"{v:.17e}" for v in arc)
    return (
        f"SELECT *, {_K} * tn * (ta + ta**3 / 6 * (1 - tt + tc) + ta**5 / 120 * (5 - 18 * tt + tt**2 + 72 * tc - 58 * {_EP})) + 5e5 AS utm_x, "
        f"{_K} * (tm + tn * tan(phi) * (ta**2 / 2 + ta**4 / 24 * (5 - tt + 9 * tc + 4 * tc**2) + ta**6 / 720 * (61 - 58 * tt + tt**2 + 600 * tc - 330 * {_EP}))) AS utm_y FROM ("
        f"SELECT *, cos(phi) * lam AS ta, tan(phi)**2 AS tt, {_EP} * cos(phi)**2 AS tc, {_A} / sqrt(1 - {_E2!r}e0 * sin(phi)**2) AS tn, "
        f"{_A} * ({m0} * phi - {m2} * sin(2 * phi) + {m4} * sin(4 * phi) - {m6} * sin(6 * phi)) AS tm FROM ("
        f"SELECT *, radians({lat}) AS phi, radians({lon} - (6 * {zone} - 183)) AS lam FROM ({source})))"
    )


def inverse_sql(source: str, x: str, y: str, zone: str) -> str:
    """``source`` with columns ``lon`` and ``lat`` in degrees, north of the equator."""
    root = (1 - _E2) ** 0.5
    e1 = (1 - root) / (1 + root)
    terms = [3 * e1 / 2 - 27 * e1**3 / 32, 21 * e1**2 / 16 - 55 * e1**4 / 32, 151 * e1**3 / 96, 1097 * e1**4 / 512]
    series = " + ".join(f"{v:.17e} * sin({2 * i + 2} * mu)" for i, v in enumerate(terms))
    arc = f"{1 - _E2 / 4 - 3 * _E2**2 / 64 - 5 * _E2**3 / 256:.17e}"
    return (
        f"SELECT *, degrees(phi - tan(phi) * iw / (1 - {_E2!r}e0) * (d**2 / 2 - d**4 / 24 * (5 + 3 * it + 10 * ic - 4 * ic**2 - 9 * {_EP}) + d**6 / 720 * (61 + 90 * it + 298 * ic + 45 * it**2 - 252 * {_EP} - 3 * ic**2))) AS lat, "
        f"degrees((d - d**3 / 6 * (1 + 2 * it + ic) + d**5 / 120 * (5 - 2 * ic + 28 * it - 3 * ic**2 + 8 * {_EP} + 24 * it**2)) / cos(phi)) + 6 * {zone} - 183 AS lon FROM ("
        f"SELECT *, ({x} - 5e5) * sqrt(iw) / ({_A} * {_K}) AS d FROM (SELECT *, {_EP} * cos(phi)**2 AS ic, tan(phi)**2 AS it, 1 - {_E2!r}e0 * sin(phi)**2 AS iw FROM ("
        f"SELECT *, mu + {series} AS phi FROM (SELECT *, {y} / ({_K} * {_A} * {arc}) AS mu FROM ({source})))))"
    )


# each edge at 22 places, widened by the most that it can bend between two of them
_TRACE = (
    "SELECT raster_id, w, e, s, n, q.px AS px, q.py AS py FROM (SELECT raster_id, w, e, s, n, unnest(["
    + ", ".join(f"struct_pack(px := {x}, py := {y})" for x, y in (("w + f * (e - w)", "n"), ("w + f * (e - w)", "s"), ("w", "s + f * (n - s)"), ("e", "s + f * (n - s)")))
    + "]) AS q FROM (SELECT *, unnest(range(22)) / 21e0 AS f FROM (SELECT raster_id, x0 AS w, y0 AS n, x0 + pixel_width * n_cols AS e, y0 - pixel_height * n_rows AS s FROM utm_meta)))"
)
_UNIT = f"({_K} * {_A} * (1 - {_E2!r}e0))"
_BEND = f"11e-1 * degrees((greatest(max(e) - min(w), max(n) - min(s)) / 21e0 / {_UNIT})**2 / 8)"
_COSH = f"(exp(greatest(abs(max(e) - 5e5), abs(min(w) - 5e5)) / {_UNIT}) + exp(-greatest(abs(max(e) - 5e5), abs(min(w) - 5e5)) / {_UNIT})) / 2"
_FLAT = f"cos(max(n) / {_UNIT})**2"
cte("utm_bldg", select(UTM_BLDG, "lineitem"))
cte("utm_meta", select(UTM_META, "(SELECT DISTINCT raster_id FROM pixel_keys)"), "pixel_keys")
cte(
    "utm_bounds",
    f"SELECT raster_id, min(lon) - ({_BEND} * {_COSH} / {_FLAT} + 1e-9) AS xmin, min(lat) - ({_BEND} * ({_COSH} + 5e-1) / {_FLAT} + 1e-9) AS ymin, "
    f"max(lon) + ({_BEND} * {_COSH} / {_FLAT} + 1e-9) AS xmax, max(lat) + ({_BEND} * ({_COSH} + 5e-1) / {_FLAT} + 1e-9) AS ymax "
    f"FROM ({inverse_sql(_TRACE, 'px', 'py', str(UTM_ZONE))}) GROUP BY raster_id",
    "utm_meta",
)
cte("utm_clipped", re.sub(r"\b(FROM|JOIN) (bldg|bounds)\b", r"\1 utm_\2", CTES["clipped"][1]), "utm_bldg", "utm_bounds")
for _way, _zone in (("point", "(floor((Longitude + 180) / 6) + 1)"), ("raster", str(UTM_ZONE))):
    cte(
        f"utm_sampled_{_way}",
        "SELECT e.* EXCLUDE (phi, lam, ta, tt, tc, tn, tm, utm_x, utm_y), CASE WHEN e.r >= 0 AND e.r < n_rows AND e.c >= 0 AND e.c < n_cols AND p.value IS NOT NULL "
        "AND p.value <> nodata THEN p.value ELSE CAST(0 AS DOUBLE) END AS depth_grid FROM (SELECT *, trunc((utm_x - x0) / pixel_width) AS c, trunc((y0 - utm_y) / pixel_height) AS r FROM ("
        + forward_sql("SELECT k.*, m.nodata, m.n_rows, m.n_cols, m.x0, m.y0, m.pixel_width, m.pixel_height FROM utm_clipped k JOIN utm_meta m USING (raster_id)", "Latitude", "Longitude", _zone)
        + ")) e LEFT JOIN pixels p ON p.raster_id = e.raster_id AND p.r = e.r AND p.c = e.c",
        "utm_clipped",
        "utm_meta",
        "pixels",
    )
    CTES.update(damage_sql(f"utm_sampled_{_way}", "CAE", False))
# the same chain for the states and rasters of one event
EVENT_STATES = ("Florida", "Georgia")
cte("event_bldg", f"SELECT * FROM bldg WHERE state IN {EVENT_STATES}", "bldg")
cte("event_bounds", "SELECT * FROM bounds WHERE raster_id LIKE 'STORMF%'", "bounds")
cte("event_clipped", re.sub(r"\b(FROM|JOIN) (bldg|bounds)\b", r"\1 event_\2", CTES["clipped"][1]), "event_bldg", "event_bounds")
cte("event_sampled", re.sub(r"\b(FROM) (clipped)\b", r"\1 event_\2", CTES["sampled"][1]), "event_clipped", "meta", "pixels")
CTES.update(damage_sql("event_sampled", "CAE", False))
# the same chain for the forty storms
cte("far_bldg", select(FAR_BLDG, "lineitem"))
cte("far_pixel_keys", select(FAR_KEYS, "orders"))
cte("far_meta", select(FAR_META, "(SELECT DISTINCT raster_id FROM far_pixel_keys)"), "far_pixel_keys")
for _name in ("pixels", "bounds", "clipped", "sampled"):
    _needs, _text = CTES[_name]
    cte(f"far_{_name}", re.sub(r"\b(FROM|JOIN) (bldg|pixel_keys|pixels|meta|bounds|clipped)\b", r"\1 far_\2", _text), *[f"far_{n}" for n in _needs])
CTES.update(damage_sql("far_sampled", "CAE", False))
CTES.update(damage_sql("exposure", "CAE", False))
cte("chosen", "SELECT * FROM exposure", "exposure")
CTES.update(damage_sql("chosen", "V", True))
