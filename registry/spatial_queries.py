"""Queries of rasters, cells and boundaries (SPA, JOI-1/6/7/8, SRC-8, PRJ-20) and of
stored sources and sinks (SRC-1..5, SRC-9/11, SNK)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F

from registry import base as b
from registry import damage_queries as dq
from registry.base import query, sql
from registry.cleaning_queries import counted
from tidemark.functions import impact as fi
from tidemark.functions import text
from tidemark.operators import boundaries, spatial
from tidemark.operators import inventory as inv
from tidemark.operators import tiles
from tidemark.plans import impact as plan
from tidemark.session import scratch_dir
from tidemark.sinks import writers
from tidemark.sources import inventory as src
from tidemark.sources import raster as rs
from tidemark.sources import tables
from tidemark.streaming import features

BOUND_COLS = ["raster_id", "xmin", "ymin", "xmax", "ymax"]


@query(
    "spa01_raster_bounds",
    sql("SELECT raster_id, round(xmin, 6) AS xmin, round(ymin, 6) AS ymin, round(xmax, 6) AS xmax, round(ymax, 6) AS ymax FROM bounds", "bounds"),
)
def _(spark, sf):
    bounds = spatial.raster_bounds(b.meta(spark, sf))
    return bounds.select("raster_id", *[F.round(c, 6).alias(c) for c in BOUND_COLS[1:]])


@query(
    "spa02_joi01_bbox_join",
    sql(
        "SELECT raster_id, state, count(*) AS n, round(sum(val_struct), 2) AS value FROM bldg JOIN bounds ON latitude BETWEEN ymin AND ymax "
        "AND longitude BETWEEN xmin AND xmax GROUP BY 1, 2",
        "bldg",
        "bounds",
    ),
)
def _(spark, sf):
    pairs = spatial.bbox_join(b.bldg(spark, sf), spatial.raster_bounds(b.meta(spark, sf)))
    return pairs.groupBy("raster_id", "state").agg(F.count("*").alias("n"), F.round(F.sum("val_struct"), 2).alias("value"))


@query(
    "spa02_rasters_over",
    sql(
        "SELECT array_to_string(list_sort(ids), ',') AS rasters, count(*) AS n FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, "
        f"l_shipdate, l_quantity, l_discount, l_tax, list(raster_id) AS ids FROM (SELECT *, {b.BLDG['longitude']} AS lon, {b.BLDG['latitude']} AS lat FROM lineitem) "
        "JOIN bounds ON lat BETWEEN ymin AND ymax AND lon BETWEEN xmin AND xmax GROUP BY ALL) GROUP BY 1",
        "bounds",
    ),
)
def _(spark, sf):
    over = spatial.rasters_over(b.bldg(spark, sf), spatial.raster_bounds(b.meta(spark, sf)))
    return counted(over, F.array_join("raster_ids", ",").alias("rasters"))


@query(
    "spa03_sample_depth",
    sql(
        "SELECT raster_id, state, count(*) AS n, count(*) FILTER (WHERE depth_grid > 0) AS wet, round(sum(depth_grid), 2) AS depth FROM sampled GROUP BY 1, 2",
        "sampled",
    ),
)
def _(spark, sf):
    meta = b.meta(spark, sf)
    rows = spatial.with_meta(plan.clipped_inventory(b.bldg(spark, sf), meta), meta)
    located = spatial.grid_position(rows, "Longitude", "Latitude")
    out = spatial.sample_depth(located, b.pixels(spark, sf))
    return out.groupBy("raster_id", "state").agg(
        F.count("*").alias("n"), F.count_if(F.col("depth_grid") > 0).alias("wet"), F.round(F.sum("depth_grid"), 2).alias("depth")
    )


@query(
    "spa03_sample_tiles",
    sql(
        "SELECT raster_id, state, count(*) AS n, count(*) FILTER (WHERE depth_grid > 0) AS wet, round(sum(depth_grid), 2) AS depth FROM sampled GROUP BY 1, 2",
        "sampled",
    ),
)
def _(spark, sf):
    """Depths from stored tiles, cut so that buildings cross many of them."""
    meta, path = b.meta(spark, sf), scratch_dir(spark)
    tiles.write_tiles(b.pixels(spark, sf), path, size=8, copies=2)
    rows = spatial.with_meta(plan.clipped_inventory(b.bldg(spark, sf), meta), meta)
    out = spatial.sample_depth(spatial.grid_position(rows, "Longitude", "Latitude"), tiles.read_tiles(spark, path))
    return out.groupBy("raster_id", "state").agg(
        F.count("*").alias("n"), F.count_if(F.col("depth_grid") > 0).alias("wet"), F.round(F.sum("depth_grid"), 2).alias("depth")
    )


def utm_sql() -> str:
    """Forward transverse Mercator of the building places, in each place's own zone."""
    zone = "(floor((longitude + 180) / 6) + 1)"
    return f"SELECT round(utm_x, -3) AS x_km, round(utm_y, -3) AS y_km, count(*) AS n FROM ({b.forward_sql('SELECT * FROM bldg', 'latitude', 'longitude', zone)}) GROUP BY ALL"


@query("spa04_project_utm", sql(utm_sql(), "bldg"))
def _(spark, sf):
    """Rounded metres of every building place in its own zone."""
    out = spatial.project_utm(b.bldg(spark, sf).select("longitude", "latitude"), "longitude", "latitude")
    return out.groupBy(F.round("utm_x", -3).alias("x_km"), F.round("utm_y", -3).alias("y_km")).agg(F.count("*").alias("n"))


@query(
    "spa01_projected_bounds",
    sql("SELECT raster_id, round(xmin, 5) AS xmin, round(ymin, 5) AS ymin, round(xmax, 5) AS xmax, round(ymax, 5) AS ymax FROM utm_bounds", "utm_bounds"),
)
def _(spark, sf):
    """Extents of rasters in metres, traced along their edges and widened by their bend."""
    bounds = spatial.raster_bounds(b.utm_meta(spark, sf))
    return bounds.select("raster_id", *[F.round(c, 5).alias(c) for c in BOUND_COLS[1:]])


def projected_sample(way):
    text_ = "SELECT raster_id, state, count(*) AS n, count(*) FILTER (WHERE depth_grid > 0) AS wet, round(sum(depth_grid), 2) AS depth FROM {0} GROUP BY 1, 2"

    @query(f"spa03_projected_{way}_zone", sql(text_.format(f"utm_sampled_{way}"), f"utm_sampled_{way}"))
    def _(spark, sf):
        """Depths of rasters in metres under buildings of two zones."""
        meta = b.utm_meta(spark, sf)
        rows = spatial.with_meta(plan.clipped_inventory(b.utm_bldg(spark, sf), meta), meta)
        out = spatial.sample_depth(spatial.grid_position(rows, "Longitude", "Latitude", way), b.pixels(spark, sf))
        return out.groupBy("raster_id", "state").agg(
            F.count("*").alias("n"), F.count_if(F.col("depth_grid") > 0).alias("wet"), F.round(F.sum("depth_grid"), 2).alias("depth")
        )


projected_sample("point")
projected_sample("raster")


@query(
    "src08_pixel_table",
    sql(
        "SELECT raster_id, count(*) AS n, min(value) AS lo, max(value) AS hi, round(sum(value), 4) AS total FROM pixels WHERE value <> -9999 GROUP BY 1",
        "pixels",
    ),
)
def _(spark, sf):
    path = scratch_dir(spark)
    rs.write_pixel_table(b.pixels(spark, sf), path)
    kept = spatial.valid_pixels(rs.read_pixel_table(spark, path), b.meta(spark, sf))
    return kept.groupBy("raster_id").agg(
        F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"), F.round(F.sum("value"), 4).alias("total")
    )


CODES = "CAST(CAST(w AS BIGINT) % 8 AS DOUBLE)"


@query(
    "prj20_remap_codes",
    sql(
        f"SELECT raster_id, CASE v WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 3 THEN 3 WHEN 4 THEN 6 WHEN 5 THEN 9 ELSE CAST(-9999 AS DOUBLE) END AS value, count(*) AS n FROM "
        f"(SELECT raster_id, {CODES} AS v FROM (SELECT raster_id, r, c, sum(w) AS w FROM pixel_keys GROUP BY 1, 2, 3)) GROUP BY 1, 2",
        "pixel_keys",
    ),
)
def _(spark, sf):
    keyed = b.project(b.table(spark, sf, "orders"), b.PIXEL_KEYS).groupBy("raster_id", "r", "c").agg(F.sum("w").alias("w"))
    coded = keyed.selectExpr("raster_id", "r", "c", f"{CODES} AS value")
    return counted(spatial.remap_codes(coded), "raster_id", "value")


@query("spa11_raster_codes", sql("SELECT raster_id, value, count(*) AS n_pixels FROM pixels GROUP BY 1, 2", "pixels"))
def _(spark, sf):
    return spatial.raster_codes(b.pixels(spark, sf))


CELL = "CAST('0.0625' AS DOUBLE)"
# west and north edge of a wet pixel, one pixel further out for the first column or row
SPAN = (
    f"SELECT raster_id, x0 + (c - CASE WHEN c = 0 THEN 1 ELSE 0 END) * pixel_width AS xa, x0 + (c + 1) * pixel_width AS xb, "
    f"y0 - (r - CASE WHEN r = 0 THEN 1 ELSE 0 END) * pixel_height AS yb, y0 - (r + 1) * pixel_height AS ya "
    "FROM pixels JOIN meta USING (raster_id) WHERE value > 0"
)
b.cte(
    "cells",
    "SELECT DISTINCT raster_id, cx, unnest(range(CAST(floor(ya / {0}) AS BIGINT), CAST(floor(yb / {0}) AS BIGINT) + 1)) AS cy FROM "
    "(SELECT *, unnest(range(CAST(floor(xa / {0}) AS BIGINT), CAST(floor(xb / {0}) AS BIGINT) + 1)) AS cx FROM ({1}))".format(CELL, SPAN),
    "pixels",
    "meta",
)


@query(
    "spa05_wet_cells",
    sql("SELECT raster_id, count(*) AS n_cells, CAST(sum(cx * 4294967296 + cy + 2147483648) AS BIGINT) AS id_sum FROM cells GROUP BY 1", "cells"),
)
def _(spark, sf):
    cells = spatial.wet_cells(b.pixels(spark, sf), b.meta(spark, sf), 0.0625)
    return cells.groupBy("raster_id").agg(F.count("*").alias("n_cells"), F.sum("cell").alias("id_sum"))


@query(
    "spa05_wet_cells_stride",
    sql(
        "SELECT raster_id, count(*) AS n_cells, CAST(sum(cx * 4294967296 + cy + 2147483648) AS BIGINT) AS id_sum FROM (SELECT DISTINCT raster_id, cx, cy FROM (SELECT raster_id, "
        f"floor((x0 + (c + CAST('0.5' AS DOUBLE)) * pixel_width) / {CELL}) AS cx, floor((y0 - (r + CAST('0.5' AS DOUBLE)) * pixel_height) / {CELL}) AS cy, "
        "row_number() OVER (PARTITION BY raster_id ORDER BY r, c) AS k FROM pixels JOIN meta USING (raster_id) WHERE value > 0) WHERE (k - 1) % 4 = 0) GROUP BY 1",
        "pixels",
        "meta",
    ),
)
def _(spark, sf):
    cells = spatial.wet_cells(b.pixels(spark, sf), b.meta(spark, sf), 0.0625, stride=4, cover="centre")
    return cells.groupBy("raster_id").agg(F.count("*").alias("n_cells"), F.sum("cell").alias("id_sum"))


@query(
    "spa06_joi06_cell_prefilter",
    sql(
        "SELECT state, count(*) AS n, round(sum(val_struct), 2) AS value FROM bldg WHERE EXISTS (SELECT 1 FROM cells WHERE "
        f"cx = floor(longitude / {CELL}) AND cy = floor(latitude / {CELL})) GROUP BY 1",
        "bldg",
        "cells",
    ),
)
def _(spark, sf):
    cells = spatial.wet_cells(b.pixels(spark, sf), b.meta(spark, sf), 0.0625)
    kept = spatial.cell_prefilter(b.bldg(spark, sf), cells, 0.0625)
    return kept.groupBy("state").agg(F.count("*").alias("n"), F.round(F.sum("val_struct"), 2).alias("value"))


@query(
    "spa07_joi07_states_in_extent",
    sql("SELECT DISTINCT raster_id, NAME FROM boxes JOIN bounds ON bx1 <= xmax AND bx2 >= xmin AND by1 <= ymax AND by2 >= ymin", "boxes", "bounds"),
)
def _(spark, sf):
    bounds = spatial.raster_bounds(b.meta(spark, sf))
    names = b.boxes(spark, sf).select("geo_id", "NAME")
    return boundaries.states_in_extent(b.box_edges(spark, sf), bounds, names)


# counties are the boxes; a county counts as loaded when some customer lives there
b.cte(
    "expected",
    "SELECT n_name AS state_name, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS county, concat('S', n_nationkey // 3) AS state FROM nation",
)
b.cte("loaded", "SELECT DISTINCT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS county FROM customer WHERE c_nationkey % 4 <> 1")


@query(
    "spa08_joi08_ingest_completeness",
    sql(
        "SELECT f.state, f.county, m.county IS NOT NULL AS meets_raster, CASE WHEN n = 0 OR m.county IS NOT NULL THEN 'error' ELSE 'warn' END AS severity, "
        "false AS cacheable FROM (SELECT e.state, e.county, l.county AS hit, count(l.county) OVER (PARTITION BY e.state) AS n FROM expected e "
        "LEFT JOIN loaded l ON e.county = l.county) f LEFT JOIN (SELECT DISTINCT geo_id AS county FROM boxes JOIN bounds ON bx1 <= xmax AND bx2 >= xmin "
        "AND by1 <= ymax AND by2 >= ymin) m ON m.county = f.county WHERE f.hit IS NULL",
        "expected",
        "loaded",
        "boxes",
        "bounds",
    ),
)
def _(spark, sf):
    key = "lpad(CAST({} AS STRING), 2, '0') AS county"
    expected = b.table(spark, sf, "nation").selectExpr("concat('S', CAST(n_nationkey DIV 3 AS STRING)) AS state", key.format("n_nationkey"))
    loaded = b.table(spark, sf, "customer").where("c_nationkey % 4 <> 1").selectExpr(key.format("c_nationkey"))
    return boundaries.ingest_completeness(expected, loaded, b.box_edges(spark, sf), spatial.raster_bounds(b.meta(spark, sf)))


IN_BOXES = "longitude > bx1 AND longitude <= bx2 AND latitude >= by1 AND latitude < by2"


@query(
    "spa09_assign_county",
    sql(f"SELECT geo_id, state, count(*) AS n FROM bldg JOIN boxes ON {IN_BOXES} GROUP BY 1, 2", "bldg", "boxes"),
)
def _(spark, sf):
    return counted(boundaries.assign_county(b.bldg(spark, sf), b.box_edges(spark, sf)), "geo_id", "state")


@query(
    "spa09_assign_county_keep",
    sql(f"SELECT geo_id, count(*) AS n FROM bldg LEFT JOIN boxes ON {IN_BOXES} GROUP BY 1", "bldg", "boxes"),
)
def _(spark, sf):
    return counted(boundaries.assign_county(b.bldg(spark, sf), b.box_edges(spark, sf), outside="keep"), "geo_id")


@query(
    "spa10_inundation_level",
    sql(
        "SELECT state, CASE WHEN depth > ground_elv + found_ht THEN 'structure' WHEN depth > ground_elv THEN 'yard' ELSE 'none' END AS level, count(*) AS n FROM bldg GROUP BY 1, 2",
        "bldg",
    ),
)
def _(spark, sf):
    level = fi.inundation_level(F.col("depth"), F.col("ground_elv"), F.col("found_ht"))
    return counted(b.bldg(spark, sf), "state", level.alias("level"))


# --- sources and sinks: written to the shared scratch folder and read back ----------
@query(
    "src01_read_inventory",
    sql("SELECT state, occtype, count(*) AS n, round(sum(val_struct), 2) AS value FROM bldg WHERE state IN ('Florida', 'Texas') GROUP BY 1, 2", "bldg"),
)
def _(spark, sf):
    df = b.bldg(spark, sf)
    path = scratch_dir(spark)
    writers.write_inventory(conformed(df), path)
    read = src.read_inventory(spark, path, ["Florida", "Texas"])
    return read.groupBy("state", "occtype").agg(F.count("*").alias("n"), F.round(F.sum("val_struct"), 2).alias("value"))


def conformed(df):
    """The 32 inventory columns plus the partition column."""
    keep = df.withColumn("firmzone", F.col("state"))
    return inv.conform_schema(keep).withColumn("state", F.col("firmzone"))


@query(
    "snk02_write_inventory",
    sql("SELECT state, count(*) AS n, count(cbfips) AS with_block, CAST(sum(pop2amu65) AS BIGINT) AS people FROM bldg GROUP BY 1", "bldg"),
)
def _(spark, sf):
    path = scratch_dir(spark)
    writers.write_inventory(conformed(b.bldg(spark, sf)), path)
    return src.read_inventory(spark, path).groupBy("state").agg(
        F.count("*").alias("n"), F.count("cbfips").alias("with_block"), F.sum("pop2amu65").alias("people")
    )


ENGINE_SUMS = "Occ, FoundationType AS foundation, count(*) AS n, round(sum(Cost), 2) AS cost, round(sum(Longitude), 4) AS lon"


def engine_sums(df):
    number = {c: text.lenient_number(text.normalize_value(F.col(c))) for c in ("Cost", "Longitude", "FoundationType")}
    return df.groupBy("Occ", number["FoundationType"].cast("int").alias("foundation")).agg(
        F.count("*").alias("n"), F.round(F.sum(number["Cost"]), 2).alias("cost"), F.round(F.sum(number["Longitude"]), 4).alias("lon")
    )


@query("src02_snk01_engine_csv", sql(f"SELECT {ENGINE_SUMS} FROM exposure GROUP BY 1, 2", "exposure"))
def _(spark, sf):
    path = scratch_dir(spark)
    writers.write_engine_input(inv.engine_columns(inv.require_fields(b.bldg(spark, sf))), path)
    return engine_sums(src.read_inventory_csv(spark, path))


@query(
    "src03_read_auto",
    sql(f"SELECT source, {ENGINE_SUMS} FROM exposure CROSS JOIN (SELECT unnest(['csv', 'parquet']) AS source) GROUP BY 1, 2, 3", "exposure"),
)
def _(spark, sf):
    root = scratch_dir(spark)
    engine = inv.engine_columns(inv.require_fields(b.bldg(spark, sf)))
    writers.write_engine_input(engine, f"{root}/input.csv")
    engine.write.parquet(f"{root}/input.parquet")
    parts = [
        engine_sums(src.read_inventory_auto(spark, f"{root}/input.{kind}")).withColumn("source", F.lit(kind)) for kind in ("csv", "parquet")
    ]
    return parts[0].unionByName(parts[1])


FEATURE_SUMS = "occtype, count(*) AS n, count(val_cont) AS contents, round(sum(longitude), 4) AS lon, round(sum(latitude), 4) AS lat"


def feature_sums(df):
    return df.groupBy("occtype").agg(
        F.count("*").alias("n"),
        F.count("val_cont").alias("contents"),
        F.round(F.sum("longitude"), 4).alias("lon"),
        F.round(F.sum("latitude"), 4).alias("lat"),
    )


def whole_stories(spark, sf):
    return b.bldg(spark, sf).withColumn("num_story", F.col("num_story").cast("long"))


@query("src04_feature_lines", sql(f"SELECT {FEATURE_SUMS} FROM bldg GROUP BY 1", "bldg"))
def _(spark, sf):
    lines = src.feature_lines(whole_stories(spark, sf))
    path = scratch_dir(spark)
    writers.write_lines(lines, path)
    return feature_sums(src.read_feature_lines(spark, path))


@query("src05_feature_collection", sql(f"SELECT {FEATURE_SUMS} FROM bldg GROUP BY 1", "bldg"))
def _(spark, sf):
    """Stored documents, one for every 4096 order keys, written line by line and read in splits."""
    raw = b.table(spark, sf, "lineitem").withColumn("fd_id", F.split(F.expr(b.BLDG["bid"]), "-")[0].cast("long")).withColumn("doc", F.expr("fd_id DIV 4096"))
    # stored rows are dealt and sorted, their text is made after that
    used = sorted({c for c in raw.columns if any(c in e for e in b.BLDG.values())})
    within = Window.partitionBy("doc").orderBy(*used)
    dealt = raw.select(*used, "fd_id", "doc").withColumns({"first": F.row_number().over(within) == 1, "last": F.lead(F.lit(1)).over(within).isNull()})
    rows = b.project(dealt, {**b.BLDG, **{c: c for c in ("fd_id", "doc", "first", "last")}, "num_story": f"CAST({b.BLDG['num_story']} AS BIGINT)"})
    opening = F.when(F.col("first"), F.lit('{"type": "FeatureCollection", "features": [\n')).otherwise(F.lit(", "))
    closing = F.when(F.col("last"), F.lit("\n]}")).otherwise(F.lit(""))
    body = src.feature_lines(rows, ["doc", "first", "last"]).select("doc", F.concat(opening, "value", closing).alias("value"))
    path = scratch_dir(spark)
    body.write.option("compression", "gzip").partitionBy("doc").text(path)
    return feature_sums(src.read_feature_collection(spark, path))


@query("str01_feature_stream", sql(f"SELECT {ENGINE_SUMS} FROM exposure GROUP BY 1, 2", "exposure"))
def _(spark, sf):
    """Feature files as a stream through the stateless operators, until none is left."""
    path = scratch_dir(spark)
    writers.write_lines(src.feature_lines(whole_stories(spark, sf)), f"{path}/in")
    rows = features.engine_stream(features.read_feature_stream(spark, f"{path}/in"))
    features.write_feature_stream(rows, f"{path}/out", f"{path}/state").awaitTermination()
    return engine_sums(spark.read.parquet(f"{path}/out"))


@query(
    "snk07_write_mode",
    sql("SELECT state, count(*) AS n, true AS refused, true AS kept FROM bldg GROUP BY 1", "bldg"),
)
def _(spark, sf):
    """A second write is refused unless it is told to replace; one that fails midway leaves the old rows."""
    path, df = scratch_dir(spark), b.bldg(spark, sf)
    writers.write_inventory(df.where("state = 'Texas'"), path)
    try:
        writers.write_inventory(df, path)
        refused = False
    except AnalysisException:
        refused = True
    broken = df.withColumn("occtype", F.when(F.col("state") == "Florida", F.raise_error(F.lit("midway"))).otherwise(F.col("occtype")))
    try:
        writers.write_inventory(broken, path, overwrite=True)
        kept = False
    except Exception:  # whatever the lost task raised: the old table counts
        kept = [r.state for r in spark.read.parquet(path).select("state").distinct().collect()] == ["Texas"]
    writers.write_inventory(df, path, overwrite=True)
    read = src.read_inventory(spark, path).groupBy("state").agg(F.count("*").alias("n"))
    return read.withColumns({"refused": F.lit(refused), "kept": F.lit(kept)})


@query(
    "prj02_set03_schema_check",
    sql("SELECT 'absent_one,zz_absent' AS missing, true AS raised, count(*) AS n FROM bldg", "bldg"),
)
def _(spark, sf):
    """Required names that the table lacks, reported and raised."""
    df = b.bldg(spark, sf)
    wanted = [*df.columns, "zz_absent", "absent_one"]
    try:
        inv.check_schema(df, wanted)
        raised = False
    except ValueError:
        raised = inv.check_schema(df, wanted, "report") == inv.schema_difference(df, wanted)
    names = ",".join(inv.schema_difference(df, wanted))
    return df.agg(F.count("*").alias("n")).select(F.lit(names).alias("missing"), F.lit(raised).alias("raised"), "n")


@query("src09_read_svi", sql("SELECT FIPS, ST_ABBR, COUNTY, E_TOTPOP, EP_GROUPQ FROM svi", "svi"))
def _(spark, sf):
    path = scratch_dir(spark)
    writers.write_geo_output(b.svi(spark, sf), path)
    return tables.read_svi(spark, path).select("FIPS", "ST_ABBR", "COUNTY", "E_TOTPOP", "EP_GROUPQ")


@query(
    "src11_ground_truth",
    "SELECT event_key, county_fips5, sum(planned) AS planned, sum(actual) AS actual FROM (SELECT concat('E', o_orderstatus) AS event_key, "
    "lpad(CAST(o_custkey % 60 AS VARCHAR), 5, '0') AS county_fips5, CAST(floor(o_totalprice / 1000) AS DOUBLE) AS planned, "
    "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(floor(o_totalprice / 2000) AS DOUBLE) END AS actual FROM orders) GROUP BY 1, 2",
)
def _(spark, sf):
    df = b.table(spark, sf, "orders").selectExpr(
        "concat('E', o_orderstatus) AS event",
        "concat('E', o_orderstatus) AS event_key",
        "CAST(CAST(o_orderdate AS DATE) AS STRING) AS landfall_date",
        "'county, with comma' AS county",
        "'COUNTY' AS county_name_norm",
        "'FL' AS state_abbr",
        "lpad(CAST(o_custkey % 60 AS STRING), 5, '0') AS county_fips5",
        "CAST(floor(o_totalprice / 1000) AS DOUBLE) AS planned_shelter_population",
        "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(floor(o_totalprice / 2000) AS DOUBLE) END AS actual_shelter_population",
        "0.0D AS estimated_population_impacted",
    )
    path = scratch_dir(spark)
    df.write.option("header", True).csv(path)
    read = tables.read_ground_truth(spark, path)
    return read.groupBy("event_key", "county_fips5").agg(
        F.sum("planned_shelter_population").alias("planned"), F.sum("actual_shelter_population").alias("actual")
    )


@query(
    "snk03_write_predictions",
    sql(
        "SELECT regexp_extract(GridName, '^(.+_[0-9]{4})_adv', 1) AS event, CAST(regexp_extract(GridName, '_adv([0-9]+)_', 1) AS INT) AS adv, GridName, "
        "count(*) AS n, round(sum(BldgLossUSD), 2) AS loss FROM res_sampled GROUP BY ALL",
        "res_sampled",
    ),
)
def _(spark, sf):
    path = scratch_dir(spark)
    writers.write_predictions(dq.engine_by_raster(spark, sf), path)
    return spark.read.parquet(path).groupBy("event", "adv", "GridName").agg(F.count("*").alias("n"), F.round(F.sum("BldgLossUSD"), 2).alias("loss"))


@query(
    "snk05_geo_output",
    sql("SELECT FIPS, E_TOTPOP, round(E_TOTPOP / 7, 6) AS ratio, COUNTY FROM svi", "svi"),
)
def _(spark, sf):
    path = scratch_dir(spark)
    writers.write_geo_output(b.svi(spark, sf).selectExpr("FIPS", "E_TOTPOP", "E_TOTPOP / 7 AS ratio", "COUNTY"), path, "json")
    return spark.read.schema("FIPS string, E_TOTPOP double, ratio double, COUNTY string").json(path)


B15 = b.BLDG["cbfips"]


@query(
    "snk06_block_join_table",
    f"SELECT {b.BLDG['bid']} AS fltyid, CASE WHEN length(f) < 15 THEN lpad(f, 15, '0') ELSE f END AS cbfips FROM (SELECT *, {B15} AS f FROM lineitem)",
)
def _(spark, sf):
    return inv.block_join_table(b.bldg(spark, sf))


STATE_CODES = [("Florida", "FL", "12"), ("Georgia", "GA", "13"), ("South Carolina", "SC", "45"), ("Texas", "TX", "48")]


@query(
    "snk08_manifest",
    sql(
        f"SELECT s.state, replace(s.state, ' ', '_') AS state_path, abbr, fips, s.n AS feature_count, coalesce(o.n, 0) AS output_rows, true AS sized, 'spark' AS engine FROM "
        f"(SELECT state, count(*) AS n FROM bldg GROUP BY 1) s JOIN ({b.values(STATE_CODES, 'state, abbr, fips')}) c ON c.state = s.state "
        "LEFT JOIN (SELECT state, count(DISTINCT bid) AS n FROM bldg WHERE occtype IS NOT NULL AND state <> 'Texas' GROUP BY 1) o ON o.state = s.state",
        "bldg",
    ),
)
def _(spark, sf):
    """Raw feature lines and stored inventory by state, their files measured, as the written JSON has it."""
    root, rows = scratch_dir(spark), whole_stories(spark, sf)
    writers.write_lines(src.feature_lines(rows.withColumn("firmzone", F.col("state"))), f"{root}/raw")
    good = rows.where("occtype IS NOT NULL AND state <> 'Texas'")
    writers.write_inventory(inv.dedup_inventory(good, ["state", "bid"]), f"{root}/stored")
    states = writers.state_manifest(spark.read.text(f"{root}/raw"), spark.read.parquet(f"{root}/stored"), F.get_json_object("value", "$.properties.firmzone"))
    writers.write_manifest(states, f"{root}/manifest", engine="spark")
    number = "bigint"
    shape = f"engine string, state string, state_path string, abbr string, fips string, feature_count {number}, raw_bytes {number}, raw_files {number}, output_rows {number}, output_bytes {number}, output_files {number}"
    read = spark.read.text(f"{root}/manifest").select(F.from_json("value", shape).alias("m")).select("m.*")
    sized = (F.col("raw_bytes") > 0) & (F.col("raw_files") > 0) & ((F.col("output_bytes") > 0) == (F.col("output_rows") > 0)) & ((F.col("output_files") > 0) == (F.col("output_rows") > 0))
    return read.select("state", "state_path", "abbr", "fips", "feature_count", "output_rows", sized.alias("sized"), "engine")


@query(
    "snk08_run_manifest",
    sql(
        "SELECT s.state, replace(s.state, ' ', '_') AS state_path, s.n AS feature_count, coalesce(o.n, 0) AS output_rows FROM (SELECT state, count(*) AS n FROM bldg GROUP BY 1) s "
        "LEFT JOIN (SELECT state, count(*) AS n FROM clipped GROUP BY 1) o ON o.state = s.state",
        "bldg",
        "clipped",
    ),
)
def _(spark, sf):
    """Rows of the inventory before and after a run's clip."""
    df = b.bldg(spark, sf)
    return writers.manifest(df, plan.clipped_inventory(df, b.meta(spark, sf)))
