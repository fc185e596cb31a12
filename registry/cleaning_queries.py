"""Queries of cleaning, naming and set operators (PRJ, FLT, WIN-1, SET, TOP-4, SRC-12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import base as b
from registry import damage_queries as dq
from registry.base import query, sql
from tidemark.functions import fixed, text
from tidemark.operators import damage as od
from tidemark.operators import inventory as inv
from tidemark.operators import naming, population
from tidemark.plans import impact as plan
from tidemark.session import scratch_dir
from tidemark.sinks import writers
from tidemark.sources import links, tables

WS = "E' \\t\\n\\r\\x0B\\x0C'"
LI = "lineitem"


def lineitem(spark, sf, exprs):
    return b.project(b.table(spark, sf, LI), exprs)


def counted(df, *keys):
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


# bldg holds 14 of the 32 fields; one is renamed to test case-insensitive matching
@query(
    "prj01_conform_schema",
    sql(
        "SELECT occtype, found_type, count(*) AS n, count(bid) AS bids, CAST(0 AS BIGINT) AS bldgtypes, "
        "CAST(sum(trunc(num_story)) AS BIGINT) AS stories, round(sum(sqft), 2) AS sqft, round(sum(longitude), 4) AS x, "
        "round(sum(latitude), 4) AS y, CAST(sum(pop2amu65) AS BIGINT) AS people FROM bldg GROUP BY 1, 2",
        "bldg",
    ),
)
def _(spark, sf):
    df = inv.conform_schema(b.bldg(spark, sf).withColumnRenamed("sqft", "SqFt"))
    return df.groupBy("occtype", "found_type").agg(
        F.count("*").alias("n"),
        F.count("bid").alias("bids"),
        F.count("bldgtype").alias("bldgtypes"),
        F.sum("num_story").alias("stories"),
        F.round(F.sum("sqft"), 2).alias("sqft"),
        F.round(F.sum("x"), 4).alias("x"),
        F.round(F.sum("y"), 4).alias("y"),
        F.sum("pop2amu65").alias("people"),
    )


@query(
    "prj03_prune_columns",
    sql(
        f"SELECT {', '.join(fixed.KEPT_FEATURE_COLUMNS)}, longitude, latitude FROM bldg",
        "bldg",
    ),
)
def _(spark, sf):
    return inv.prune_columns(b.bldg(spark, sf))


@query(
    "prj04_field_map",
    sql(
        "SELECT Occ, count(*) AS n, round(sum(CASE WHEN a = '' THEN 0 ELSE CAST(a AS DOUBLE) END), 2) AS area, "
        "count(*) FILTER (WHERE a = '') AS missing, count(*) FILTER (WHERE FoundationType = 4) AS basements FROM "
        "(SELECT *, CASE WHEN NumStories = 2 THEN '' ELSE CAST(CAST(Area AS BIGINT) AS VARCHAR) END AS a FROM exposure) GROUP BY 1",
        "exposure",
    ),
)
def _(spark, sf):
    rows = inv.engine_columns(inv.require_fields(b.bldg(spark, sf)))
    area = F.when(F.col("NumStories") == 2, F.lit(" NaN ")).otherwise(F.col("Area").cast("long").cast("string"))
    named = rows.withColumn("user_area", area).drop("Area").withColumnRenamed("Occ", "user_occ")
    mapping = {k: k for k in ("Cost", "NumStories", "FoundationType", "FirstFloorHt", "ContentCost", "Latitude", "Longitude")}
    mapping |= {"UserDefinedFltyId": "FltyId", "OCC": "user_occ", "Area": "user_area"}
    df = inv.apply_field_map(named, mapping)
    return df.groupBy(F.col("f_occ").alias("Occ")).agg(
        F.count("*").alias("n"),
        F.round(F.sum("f_area"), 2).alias("area"),
        F.count_if("f_missing").alias("missing"),
        F.count_if(F.col("f_foundation") == 4).alias("basements"),
    )


MESSY = (
    "CASE l_linenumber WHEN 1 THEN ' NaN ' WHEN 2 THEN 'null' WHEN 3 THEN concat(chr(9), 'abc', chr(10)) "
    "WHEN 4 THEN NULL WHEN 5 THEN concat(' ', l_returnflag, ' x ') WHEN 6 THEN 'NONE' ELSE '  ' END"
)


@query(
    "prj05_normalize_value",
    f"SELECT v, count(*) AS n FROM (SELECT CASE WHEN m IS NULL OR lower(trim(m, {WS})) IN ('nan', 'none', 'null') THEN '' "
    f"ELSE trim(m, {WS}) END AS v FROM (SELECT {MESSY} AS m FROM lineitem)) GROUP BY 1",
)
def _(spark, sf):
    return counted(lineitem(spark, sf, {"m": MESSY}), text.normalize_value(F.col("m")).alias("v"))


NUMBERS = (
    "CASE l_linenumber WHEN 1 THEN concat(' ', CAST(CAST(l_quantity AS BIGINT) AS STRING), '.5 ') WHEN 2 THEN '' "
    "WHEN 3 THEN NULL WHEN 4 THEN concat('x', l_returnflag) WHEN 5 THEN '1e3' WHEN 6 THEN '-7' ELSE '  ' END"
)


@query(
    "prj06_lenient_number",
    f"SELECT number, CASE WHEN number IS NULL THEN t END AS word, count(*) AS n FROM (SELECT t, CASE WHEN t IS NULL OR t = '' THEN "
    f"CAST(0 AS DOUBLE) ELSE try_cast(t AS DOUBLE) END AS number FROM (SELECT trim({NUMBERS}, {WS}) AS t FROM lineitem)) GROUP BY 1, 2",
)
def _(spark, sf):
    v = lineitem(spark, sf, {"m": NUMBERS}).select(text.lenient_value(F.col("m")).alias("v"))
    return counted(v, F.col("v.number").alias("number"), F.col("v.text").alias("word"))


@query("prj07_occ_class", sql(f"SELECT occtype, {b.OCC} AS occ, count(*) AS n FROM bldg GROUP BY 1, 2", "bldg"))
def _(spark, sf):
    return counted(b.bldg(spark, sf), "occtype", text.occ_class(F.col("occtype")).alias("occ"))


@query("prj08_foundation_code", sql(f"SELECT found_type, {b.FOUNDATION} AS code, count(*) AS n FROM bldg GROUP BY 1, 2", "bldg"))
def _(spark, sf):
    return counted(b.bldg(spark, sf), "found_type", text.foundation_code(F.col("found_type")).alias("code"))


# dashes and a 17-digit value, which must stay whole
FIPS = f"CASE WHEN l_linenumber = 5 THEN concat('9-', {b.BLDG['cbfips']}, '.0') ELSE {b.BLDG['cbfips']} END"
DIGITS = "regexp_replace(f, '[^0-9]', '', 'g')"
PADDED = f"CASE WHEN length({DIGITS}) < 15 THEN lpad({DIGITS}, 15, '0') ELSE {DIGITS} END"


@query(
    "prj09_block_fips",
    f"SELECT kept, zeros, count(*) AS n FROM (SELECT {PADDED} AS kept, coalesce({PADDED}, repeat('0', 15)) AS zeros "
    f"FROM (SELECT {FIPS} AS f FROM lineitem)) GROUP BY 1, 2",
)
def _(spark, sf):
    f = lineitem(spark, sf, {"f": FIPS})
    return counted(f, text.block_fips(F.col("f")).alias("kept"), text.block_fips(F.col("f"), "zeros").alias("zeros"))


@query(
    "prj10_geoids",
    f"SELECT substr(k, 1, 11) AS tract, substr(k, 1, 5) AS county, substr(k, 1, 2) AS state, "
    f"substr(coalesce(k, '000000000000nan'), 1, 11) AS tract_parity, count(*) AS n FROM (SELECT {PADDED} AS k FROM "
    f"(SELECT {FIPS} AS f FROM lineitem)) GROUP BY 1, 2, 3, 4",
)
def _(spark, sf):
    k = lineitem(spark, sf, {"f": FIPS}).select(text.block_fips(F.col("f")).alias("k"))
    c = F.col("k")
    return counted(
        k,
        text.geoid(c, "tract").alias("tract"),
        text.geoid(c, "county").alias("county"),
        text.geoid(c, "state").alias("state"),
        text.geoid(c, "tract", "nan_text").alias("tract_parity"),
    )


CLASSES = (
    "CASE l_linenumber WHEN 1 THEN ' CoastalA ' WHEN 2 THEN 'VE' WHEN 3 THEN 'riverine' WHEN 4 THEN ' Lake ' "
    "WHEN 5 THEN NULL WHEN 6 THEN 'HAZARDRIVERINE' ELSE 'coastalv' END"
)


@query(
    "prj11_flood_class",
    "SELECT flood, code, count(*) AS n FROM (SELECT f AS flood, CASE WHEN lower(trim(f)) IN ('riverine', 'hazardriverine') THEN 'HazardRiverine' "
    "WHEN lower(trim(f)) IN ('coastala', 'cae') THEN 'CAE' WHEN lower(trim(f)) IN ('coastalv', 'v', 've') THEN 'V' "
    f"ELSE coalesce(trim(f), '') END AS code FROM (SELECT {CLASSES} AS f FROM lineitem)) GROUP BY 1, 2",
)
def _(spark, sf):
    return counted(lineitem(spark, sf, {"flood": CLASSES}), "flood", text.flood_class(F.col("flood")).alias("code"))


RASTERS = "concat(' ', l_returnflag, '.tif , ,', l_linestatus, '.tif,')"


@query(
    "prj12_raster_list",
    f"SELECT raster, count(*) AS n FROM (SELECT trim(unnest(string_split({RASTERS}, ','))) AS raster FROM lineitem) WHERE raster <> '' GROUP BY 1",
)
def _(spark, sf):
    return counted(od.raster_list_rows(lineitem(spark, sf, {"given": RASTERS}), "given"), "raster")


@query(
    "prj13_lowercase_columns",
    sql("SELECT Occ AS occ, FoundationType AS foundationtype, count(*) AS n FROM exposure GROUP BY 1, 2", "exposure"),
)
def _(spark, sf):
    low = inv.lowercase_columns(inv.engine_columns(inv.require_fields(b.bldg(spark, sf))))
    return counted(low, "occ", "foundationtype")


STATES = (
    "CASE o_custkey % 10 WHEN 0 THEN ' fl ' WHEN 1 THEN '12' WHEN 2 THEN 'Florida' WHEN 3 THEN 'new_york' "
    "WHEN 4 THEN 'District-of  Columbia' WHEN 5 THEN 'XX' WHEN 6 THEN '99' WHEN 7 THEN 'north   CAROLINA' "
    "WHEN 8 THEN 'Atlantis' ELSE 'Tx' END"
)
b.cte("state_names", b.values(fixed.US_STATES, "name, abbr, fips"))
STATE_TOKEN = (
    "CASE WHEN regexp_full_match(trim(given), '[0-9]{2}') THEN trim(given) WHEN regexp_full_match(trim(given), '[A-Za-z]{2}') "
    "THEN upper(trim(given)) ELSE lower(trim(regexp_replace(translate(given, '_-', '  '), ' +', ' ', 'g'))) END"
)


def stated(spark, sf):
    return b.project(b.table(spark, sf, "orders"), {"given": STATES})


@query(
    "prj14_normalize_state",
    sql(
        f"SELECT g.given, s.name, s.abbr, s.fips, count(*) AS n FROM (SELECT given, {STATE_TOKEN} AS token FROM (SELECT {STATES} AS given "
        "FROM orders)) g LEFT JOIN state_names s ON g.token IN (s.fips, s.abbr, lower(s.name)) GROUP BY 1, 2, 3, 4",
        "state_names",
    ),
)
def _(spark, sf):
    return counted(naming.normalize_state(stated(spark, sf), "given"), "given", "name", "abbr", "fips")


@query(
    "prj14_unknown_states",
    sql(
        f"SELECT DISTINCT given FROM (SELECT given, {STATE_TOKEN} AS token FROM (SELECT {STATES} AS given FROM orders)) g "
        "WHERE NOT EXISTS (SELECT 1 FROM state_names s WHERE g.token IN (s.fips, s.abbr, lower(s.name)))",
        "state_names",
    ),
)
def _(spark, sf):
    return naming.unknown_states(stated(spark, sf), "given")


@query(
    "prj15_state_partition",
    "SELECT given, CASE trim(given) WHEN 'new york' THEN 'New_York' WHEN 'DISTRICT of columbia' THEN 'District_Of_Columbia' ELSE 'Texas' END AS path, "
    "count(*) AS n FROM (SELECT CASE o_custkey % 3 WHEN 0 THEN 'new york' WHEN 1 THEN ' DISTRICT of columbia' ELSE 'texas' END AS given FROM orders) GROUP BY 1, 2",
)
def _(spark, sf):
    given = "CASE o_custkey % 3 WHEN 0 THEN 'new york' WHEN 1 THEN ' DISTRICT of columbia' ELSE 'texas' END"
    df = b.project(b.table(spark, sf, "orders"), {"given": given})
    return counted(df, "given", text.state_partition(F.col("given")).alias("path"))


STORMS = {
    "storm_id": "concat(CASE o_orderstatus WHEN 'F' THEN 'al' WHEN 'O' THEN 'EP' ELSE 'xyz' END, CAST(o_custkey % 20 + 1 AS STRING), "
    "CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '24' ELSE '2023' END)",
    "advisory": "CAST(o_custkey % 45 + 1 AS INT)",
    "year": "CAST(2020 + o_orderkey % 5 AS INT)",
}
PATTERN = "'^([A-Z]{2})([0-9]{1,2})([0-9]{2,4})?$'"
b.cte("requests", "SELECT DISTINCT * FROM (" + b.select(STORMS, "orders") + ")")
b.cte(
    "normalized",
    f"SELECT *, CASE WHEN regexp_matches(upper(storm_id), {PATTERN}) THEN concat(regexp_extract(upper(storm_id), {PATTERN}, 1), "
    f"lpad(regexp_extract(upper(storm_id), {PATTERN}, 2), 2, '0'), CASE length(regexp_extract(upper(storm_id), {PATTERN}, 3)) "
    f"WHEN 0 THEN CAST(year AS VARCHAR) WHEN 4 THEN regexp_extract(upper(storm_id), {PATTERN}, 3) "
    f"ELSE concat('20', regexp_extract(upper(storm_id), {PATTERN}, 3)) END) ELSE concat(upper(storm_id), year) END AS normalized_id FROM requests",
    "requests",
)
b.cte(
    "candidates",
    "SELECT storm_id, advisory, year, normalized_id, min(k) AS k, name, tier FROM (SELECT *, unnest([0, 1, 2, 3, 4, 5]) AS k, unnest(["
    "concat(s, '_', advisory, '_tidalmask.zip'), concat(s, '_', lpad(CAST(advisory AS VARCHAR), 3, '0'), '_tidalmask.zip'), "
    "concat(normalized_id, '_', advisory, '_tidalmask.zip'), concat(normalized_id, '_', lpad(CAST(advisory AS VARCHAR), 3, '0'), '_tidalmask.zip'), "
    "concat(s, '_tidalmask_latest.zip'), concat(normalized_id, '_tidalmask_latest.zip')]) AS name, unnest([0, 0, 0, 0, 1, 1]) AS tier FROM "
    "(SELECT *, concat(substr(normalized_id, 1, 4), right(CAST(year AS VARCHAR), 2)) AS s FROM normalized)) GROUP BY ALL",
    "normalized",
)
b.cte(
    "ranked_candidates",
    "SELECT *, CAST(row_number() OVER (PARTITION BY storm_id, advisory, year ORDER BY k) - 1 AS INT) AS rank FROM candidates",
    "candidates",
)
b.cte(
    "archive_links",
    "SELECT DISTINCT name, concat('https://example.com/', name) AS url FROM ranked_candidates WHERE (tier = 0 AND rank = 1 AND advisory % 3 = 0) "
    "OR (tier = 1 AND year % 2 = 0)",
    "ranked_candidates",
)


def requests(spark, sf):
    return b.project(b.table(spark, sf, "orders"), STORMS).distinct()


@query("prj16_storm_id", sql("SELECT storm_id, year, normalized_id, count(*) AS n FROM normalized GROUP BY 1, 2, 3", "normalized"))
def _(spark, sf):
    return counted(requests(spark, sf), "storm_id", "year", text.storm_id(F.col("storm_id"), F.col("year")).alias("normalized_id"))


@query("prj17_candidate_archives", sql("SELECT storm_id, advisory, year, rank, name, tier FROM ranked_candidates", "ranked_candidates"))
def _(spark, sf):
    return naming.candidate_archives(requests(spark, sf)).drop("normalized_id")


@query(
    "prj18_resolve_archives",
    sql(
        "SELECT storm_id, advisory, year, rank, name, url, tier FROM (SELECT c.*, l.url, min(tier) OVER (PARTITION BY storm_id, advisory, year) AS best "
        "FROM ranked_candidates c JOIN archive_links l USING (name)) WHERE tier = best",
        "ranked_candidates",
        "archive_links",
    ),
)
def _(spark, sf):
    cands = naming.candidate_archives(requests(spark, sf))
    found = cands.where("(tier = 0 AND rank = 1 AND advisory % 3 = 0) OR (tier = 1 AND year % 2 = 0)")
    known = found.select("name", F.concat(F.lit("https://example.com/"), "name").alias("url")).distinct()
    return naming.resolve_archives(cands, known, ["storm_id", "advisory", "year"])


@query(
    "prj18_resolve_archives_fallback",
    sql(
        "SELECT storm_id, advisory, year, rank, name, coalesce(url, 'https://example.com/try/' || name) AS url, t AS tier FROM (SELECT *, min(t) OVER (PARTITION BY storm_id, advisory, year) AS best "
        "FROM (SELECT c.*, l.url, CASE WHEN l.url IS NULL THEN 99 ELSE c.tier END AS t FROM ranked_candidates c LEFT JOIN archive_links l USING (name))) WHERE t = best",
        "ranked_candidates",
        "archive_links",
    ),
)
def _(spark, sf):
    """Requests without a link keep all their names, to be tried."""
    cands = naming.candidate_archives(requests(spark, sf))
    found = cands.where("(tier = 0 AND rank = 1 AND advisory % 3 = 0) OR (tier = 1 AND year % 2 = 0)")
    known = found.select("name", F.concat(F.lit("https://example.com/"), "name").alias("url")).distinct()
    return naming.resolve_archives(cands, known, ["storm_id", "advisory", "year"], "https://example.com/try/")


@query(
    "prj19_raster_name",
    sql(
        "SELECT regexp_extract(raster_id, '^(.+_[0-9]{4})_adv[0-9]+_e10_', 1) AS event, "
        "CAST(regexp_extract(raster_id, '_adv([0-9]+)_e10_', 1) AS INT) AS adv, raster_id AS built, count(*) AS n FROM pixel_keys GROUP BY ALL",
        "pixel_keys",
    ),
)
def _(spark, sf):
    ids = b.project(b.table(spark, sf, "orders"), b.PIXEL_KEYS)
    event, adv = text.raster_event(F.col("raster_id")), text.raster_advisory(F.col("raster_id"))
    parsed = ids.select(event.alias("event"), adv.alias("adv"))
    built = text.raster_name(F.split_part("event", F.lit("_"), F.lit(1)), F.split_part("event", F.lit("_"), F.lit(2)), F.col("adv"))
    return counted(parsed, "event", "adv", built.alias("built"))


RANGES = "CASE WHEN l_linenumber < 4 THEN concat('0.', CAST(l_suppkey % 90 + 10 AS STRING), ' - 0.99') WHEN l_linenumber < 6 THEN " \
    "concat(CAST(CAST(l_quantity AS BIGINT) AS STRING), ' - 60') ELSE 'n/a' END"


@query(
    "prj21_range_pct",
    "SELECT 'number' AS kind, CAST(l_quantity AS VARCHAR) AS given, CAST(l_quantity AS DOUBLE) AS pct, count(*) AS n FROM lineitem GROUP BY ALL UNION ALL SELECT 'text', given, round(CASE WHEN v > 1 THEN v / 100 ELSE v END, 6) AS pct, count(*) AS n FROM (SELECT given, "
    f"try_cast(nullif(regexp_extract(given, '([0-9.]+)', 1), '') AS DOUBLE) AS v FROM (SELECT {RANGES} AS given FROM lineitem)) GROUP BY 2, 3",
)
def _(spark, sf):
    """Ranges given as text, and numeric cells, which pass as they are."""
    df = lineitem(spark, sf, {"given": RANGES})
    texts = counted(df, F.lit("text").alias("kind"), "given", F.round(text.range_pct(F.col("given")), 6).alias("pct"))
    number = b.table(spark, sf, LI).withColumn("cell", F.col("l_quantity").cast("double"))
    cells = counted(number, F.lit("number").alias("kind"), F.col("cell").cast("string").alias("given"), text.range_pct(F.col("cell"), numeric=True).alias("pct"))
    return cells.unionByName(texts)


@query(
    "prj22_overlay_params",
    "SELECT coalesce(d.key, o.key) AS key, CASE WHEN o.key IS NOT NULL THEN o.value ELSE d.value END AS value FROM "
    "(SELECT DISTINCT concat('part.', p_partkey % 500) AS key, 'default' AS value FROM part) d FULL JOIN "
    "(SELECT concat('part.', l_partkey % 700) AS key, CASE WHEN count(*) % 4 = 0 THEN NULL ELSE CAST(count(*) AS VARCHAR) END AS value "
    "FROM lineitem GROUP BY 1) o ON d.key = o.key",
)
def _(spark, sf):
    defaults = b.table(spark, sf, "part").selectExpr("concat('part.', p_partkey % 500) AS key", "'default' AS value").distinct()
    keyed = b.table(spark, sf, LI).groupBy(F.expr("concat('part.', l_partkey % 700)").alias("key"))
    overrides = keyed.agg(F.expr("CASE WHEN count(*) % 4 = 0 THEN NULL ELSE CAST(count(*) AS STRING) END").alias("value"))
    return naming.overlay_params(defaults, overrides)


BBOX = (-81.9, 27.1, -79.9, 27.9)
IN_BOX = "latitude BETWEEN CAST('27.1' AS DOUBLE) AND CAST('27.9' AS DOUBLE) AND longitude BETWEEN CAST('-81.9' AS DOUBLE) AND CAST('-79.9' AS DOUBLE)"


@query("flt01_bbox_filter", sql(f"SELECT state, count(*) AS n, min(longitude) AS west, max(latitude) AS north FROM bldg WHERE {IN_BOX} GROUP BY 1", "bldg"))
def _(spark, sf):
    kept = inv.bbox_filter(b.bldg(spark, sf), *BBOX)
    return kept.groupBy("state").agg(F.count("*").alias("n"), F.min("longitude").alias("west"), F.max("latitude").alias("north"))


@query("flt02_require_fields", sql(f"SELECT occtype, state, count(*) AS n FROM bldg WHERE {b.STRICT} GROUP BY 1, 2", "bldg"))
def _(spark, sf):
    return counted(inv.require_fields(b.bldg(spark, sf)), "occtype", "state")


GAPS = {
    **{k: b.BLDG[k] for k in ("bid", "occtype", "found_type", "longitude", "cbfips")},
    "latitude": f"CASE WHEN l_linenumber = 6 THEN NULL ELSE {b.BLDG['latitude']} END",
    **{
        c: f"CASE WHEN l_linenumber = {i + 1} THEN NULL ELSE {b.BLDG[c]} END"
        for i, c in enumerate(("val_struct", "sqft", "num_story", "found_ht", "val_cont"))
    },
}
b.cte("gaps", b.select(GAPS, "lineitem"))


@query(
    "flt03_fill_defaults",
    sql(
        "SELECT found_type, count(*) AS n, round(sum(coalesce(val_struct, 0)), 2) AS val_struct, round(sum(coalesce(sqft, 0)), 2) AS sqft, "
        "round(sum(coalesce(num_story, 1)), 2) AS num_story, round(sum(coalesce(found_ht, 1)), 2) AS found_ht, "
        "round(sum(coalesce(val_cont, 0)), 2) AS val_cont FROM gaps WHERE latitude IS NOT NULL GROUP BY 1",
        "gaps",
    ),
)
def _(spark, sf):
    filled = inv.fill_defaults(lineitem(spark, sf, GAPS))
    sums = [F.round(F.sum(c), 2).alias(c) for c in ("val_struct", "sqft", "num_story", "found_ht", "val_cont")]
    return filled.groupBy("found_type").agg(F.count("*").alias("n"), *sums)


@query(
    "flt03_engine_input_fill",
    sql(
        f"SELECT Occ, FoundationType, count(*) AS n, round(sum(Cost), 2) AS cost, round(sum(NumStories), 2) AS stories FROM (SELECT {b.OCC} AS Occ, "
        f"{b.FOUNDATION} AS FoundationType, coalesce(val_struct, 0) AS Cost, coalesce(num_story, 1) AS NumStories FROM (SELECT *, row_number() OVER "
        "(PARTITION BY bid ORDER BY val_struct DESC NULLS LAST, occtype NULLS FIRST, sqft NULLS FIRST, num_story NULLS FIRST, found_type NULLS FIRST, "
        f"found_ht NULLS FIRST, latitude NULLS FIRST, longitude NULLS FIRST, val_cont NULLS FIRST) AS rn FROM gaps WHERE {IN_BOX}) WHERE rn = 1) GROUP BY 1, 2",
        "gaps",
    ),
)
def _(spark, sf):
    out = inv.engine_input(lineitem(spark, sf, GAPS), BBOX, "fill")
    return out.groupBy("Occ", "FoundationType").agg(
        F.count("*").alias("n"), F.round(F.sum("Cost"), 2).alias("cost"), F.round(F.sum("NumStories"), 2).alias("stories")
    )


RESIDENTIAL = ", ".join(f"'{t}'" for t in fixed.RESIDENTIAL_TYPES if t != "RES2")


@query("flt04_residential", sql(f"SELECT Occ AS occ, count(*) AS n FROM exposure WHERE Occ IN ({RESIDENTIAL}) GROUP BY 1", "exposure"))
def _(spark, sf):
    flags = dict.fromkeys(fixed.RESIDENTIAL_TYPES, "Y") | {"RES2": "N"}
    low = inv.lowercase_columns(inv.engine_columns(inv.require_fields(b.bldg(spark, sf))))
    return counted(inv.residential_filter(low, flags), "occ")


@query(
    "win01_agg01_engine_input",
    sql(
        f"SELECT {b.ENGINE} FROM (SELECT *, row_number() OVER (PARTITION BY bid ORDER BY val_struct DESC NULLS LAST, {b.TIES.split(', cbfips')[0]}) AS rn "
        f"FROM bldg WHERE {b.STRICT} AND {IN_BOX}) WHERE rn = 1",
        "bldg",
    ),
)
def _(spark, sf):
    return inv.engine_input(b.bldg(spark, sf), BBOX)


@query(
    "set01_union_states",
    sql("SELECT state, count(*) AS n, count(ground_elv) AS with_elevation FROM bldg GROUP BY 1", "bldg"),
)
def _(spark, sf):
    df = b.bldg(spark, sf)
    parts = [df.where(F.col("state") == s) for s in ("Texas", "Georgia", "Florida", "South Carolina")]
    every = inv.union_states(parts[0], parts[1].select(*reversed(df.columns)), *parts[2:])
    return every.groupBy("state").agg(F.count("*").alias("n"), F.count("ground_elv").alias("with_elevation"))


@query(
    "set02_stable_distinct",
    "SELECT c AS customer, min(o_orderkey) AS pos FROM (SELECT o_custkey % 400 AS c, o_orderkey FROM orders) GROUP BY 1",
)
def _(spark, sf):
    df = b.table(spark, sf, "orders").selectExpr("o_custkey % 400 AS customer", "o_orderkey AS pos")
    return naming.stable_distinct(df, ["customer"], "pos")


@query(
    "top04_last_advisories",
    sql(
        "SELECT storm, name, rn FROM (SELECT storm, name, CAST(row_number() OVER (PARTITION BY storm ORDER BY name DESC) AS INT) AS rn FROM "
        "(SELECT DISTINCT normalized_id AS storm, name FROM ranked_candidates WHERE tier = 0)) WHERE rn <= 3",
        "ranked_candidates",
    ),
)
def _(spark, sf):
    files = naming.candidate_archives(requests(spark, sf)).where("tier = 0").withColumnRenamed("normalized_id", "storm")
    return naming.last_advisories(files, "storm")


EVENT_ROWS = [
    ("storm_f", ["Florida", "Georgia"], "STORMF_2024"),
    ("storm_o", ["Texas"], "StormO_2024"),
    ("storm_p", ["South Carolina", "Georgia"], "STORMP_2024"),
]
EVENT_STATES = [(e, s, p) for e, states, p in EVENT_ROWS for s in states]
b.cte("event_states", b.values(EVENT_STATES, "event, state, raster_pattern"))


def events(spark):
    lit = ", ".join(f"('{e}', array({', '.join(repr(s) for s in states)}), '{p}')" for e, states, p in EVENT_ROWS)
    return spark.sql(f"SELECT * FROM VALUES {lit} AS t(event, states, raster_pattern)")


@query(
    "src10_joi13_event_states",
    sql("SELECT e.event, b.state, count(*) AS n FROM bldg b JOIN event_states e ON e.state = b.state GROUP BY 1, 2", "bldg", "event_states"),
)
def _(spark, sf):
    """The event table as its settings file, read by the reader."""
    path = scratch_dir(spark)
    entries = F.concat(F.lit("  "), "event", F.lit(":\n    states: ["), F.array_join("states", ", "), F.lit(']\n    raster_pattern: "'), "raster_pattern", F.lit('"'))
    body = F.concat(F.lit("# events\nevents:\n"), F.array_join(F.collect_list(entries), "\n"))
    events(spark).agg(body.alias("value")).coalesce(1).write.text(path)
    pairs = naming.explode_event_states(tables.read_event_states(spark, path))
    return counted(b.bldg(spark, sf).drop("event").join(pairs, "state"), "event", "state")


@query(
    "imp14_event_inventory",
    sql(
        "SELECT b.state, count(*) AS n, round(sum(val_struct), 2) AS value FROM bldg b JOIN event_states e ON e.state = b.state WHERE e.event = 'storm_p' GROUP BY 1",
        "bldg",
        "event_states",
    ),
)
def _(spark, sf):
    rows = population.event_inventory(b.bldg(spark, sf).drop("event"), events(spark), "storm_p")
    return rows.groupBy("state").agg(F.count("*").alias("n"), F.round(F.sum("val_struct"), 2).alias("value"))


@query(
    "imp14_event_run",
    sql(
        f"SELECT GridName, state, status, count(*) AS n, round(sum(Depth_Grid), 2) AS depth, {dq.total_sql('BldgLossUSD')} FROM res_event_sampled GROUP BY 1, 2, 3",
        "res_event_sampled",
    ),
)
def _(spark, sf):
    """A damage run of one event over the inventory stored by state."""
    path = scratch_dir(spark)
    writers.write_inventory(b.bldg(spark, sf), f"{path}/inventory")
    events(spark).write.parquet(f"{path}/events")
    stored = spark.read.parquet(f"{path}/inventory")
    params = plan.RunParams.of({"event": "storm_f"})
    out = plan.damage_by_raster(stored, b.meta(spark, sf), b.pixels(spark, sf), b.lookups(spark), params, spark.read.parquet(f"{path}/events"))
    return out.groupBy("GridName", "state", "status").agg(
        F.count("*").alias("n"), F.round(F.sum("Depth_Grid"), 2).alias("depth"), *dq.total("BldgLossUSD")
    )


HREF = "'(?i)href=\"([^\"]+)\"'"
ORIGIN = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1)"
FOLDER = "regexp_extract(regexp_replace(url, '[?#].*$', ''), '^([A-Za-z][A-Za-z0-9+.-]*://.*/)', 1)"


@query(
    "src12_archive_links",
    f"SELECT name, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href WHEN href[1:2] = '//' THEN "
    f"concat(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*:)', 1), href) WHEN href[1:1] = '/' THEN concat({ORIGIN}, href) "
    f"WHEN length({FOLDER}) > length({ORIGIN}) + 1 THEN concat({FOLDER}, href) ELSE concat({ORIGIN}, '/', href) END AS url FROM ("
    "SELECT *, row_number() OVER (PARTITION BY name ORDER BY page_id DESC, k DESC) AS rn FROM (SELECT page_id, url, href, k, "
    "regexp_extract(href, '([^/]*)/*$', 1) AS name FROM (SELECT page_id, url, unnest(h) AS href, unnest(range(len(h))) AS k FROM "
    f"(SELECT page_id, url, regexp_extract_all(html, {HREF}, 1) AS h FROM pages)))) WHERE rn = 1",
)
def _(spark, sf):
    return links.extract_archive_links(b.table(spark, sf, "pages"), suffix="")
