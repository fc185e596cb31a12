"""Queries of geography, population and validation operators (JOI, AGG, WIN-2, IMP, TOP)."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import base as b
from registry.base import query, sql
from registry.cleaning_queries import counted
from tidemark.functions import fixed
from tidemark.functions import impact as fi
from tidemark.functions import text
from tidemark.operators import geography as geo
from tidemark.operators import inventory as inv
from tidemark.operators import population as pop
from tidemark.operators import validation as val
from tidemark.plans import impact as plan
from tidemark.session import scratch_dir
from tidemark.sinks import writers

LABELS = ["Destroyed", "Major", "Minor", "Affected"]

# per-building results derived from the inventory; ids repeat, blocks may be missing
PRED = {
    "fltyid": b.BLDG["bid"],
    "occ": f"upper(split_part({b.BLDG['occtype']}, '-', 1))",
    "depth_grid": b.BLDG["depth"],
    "bldgdmgpct": "CAST((l_partkey * 3 + l_suppkey * 5) % 81 AS DOUBLE) * CAST('1.25' AS DOUBLE)",
    "bldglossusd": "l_extendedprice * CAST('0.25' AS DOUBLE)",
    "block": b.BLDG["cbfips"],
    "state": b.BLDG["state"],
    "flc": "CASE l_linenumber % 2 WHEN 0 THEN 'CoastalA' ELSE 'Riverine' END",
    "event": b.BLDG["event"],
    "adv": b.BLDG["adv"],
    **{c: b.BLDG[c] for c in ("pop2amu65", "pop2amo65", "pop2pmu65", "pop2pmo65")},
}
PAD = "CASE WHEN length(block) < 15 THEN lpad(block, 15, '0') ELSE block END"
b.cte("pred", "SELECT *, substr(cbfips, 1, 11) AS tract_geoid, substr(cbfips, 1, 5) AS county_geoid, substr(cbfips, 1, 2) AS state_geoid FROM "
      f"(SELECT *, {PAD} AS cbfips FROM ({b.select(PRED, 'lineitem')}))")  # fmt: skip
RES = ", ".join(f"'{t}'" for t in fixed.RESIDENTIAL_TYPES)
CATEGORY = (
    "CASE WHEN depth_grid >= 9 THEN 'Destroyed' WHEN depth_grid >= 6 THEN 'Major' WHEN depth_grid >= 3 THEN 'Minor' "
    "WHEN depth_grid >= 1 THEN 'Affected' ELSE 'None' END"
)
ZONE = (
    "CASE WHEN depth_grid > 12 THEN 'HIGH' WHEN depth_grid >= 9 THEN 'MEDIUM' WHEN depth_grid >= 4 THEN 'LOW' "
    "WHEN bldgdmgpct > 35 THEN 'HIGH' WHEN bldgdmgpct > 15 THEN 'MEDIUM' WHEN bldgdmgpct > 0 THEN 'LOW' ELSE 'NONE' END"
)
STATE = (
    "CASE WHEN bldgdmgpct < 15 THEN 'Slight' WHEN bldgdmgpct < 40 THEN 'Moderate' WHEN bldgdmgpct < 60 THEN 'Extensive' ELSE 'Complete' END"
)
b.cte("homes", f"SELECT *, {CATEGORY} AS damage_category, {ZONE} AS zone, {STATE} AS damage_state FROM pred WHERE occ IN ({RES})", "pred")


def pred(spark, sf):
    df = b.project(b.table(spark, sf, "lineitem"), PRED)
    return geo.with_geoids(df.withColumn("cbfips", text.block_fips(F.col("block"))))


def homes(spark, sf):
    df = geo.classify(inv.residential_filter(pred(spark, sf)), LABELS)
    zone = fi.intensity_zone(F.col("depth_grid"), F.col("bldgdmgpct"))
    return df.withColumns({"zone": zone, "damage_state": fi.damage_state(F.col("bldgdmgpct"))})


@query(
    "agg02_dedup_predictions",
    sql(
        "SELECT fltyid, bldgdmgpct, depth_grid FROM (SELECT *, row_number() OVER (PARTITION BY fltyid ORDER BY bldgdmgpct DESC, depth_grid DESC, occ NULLS FIRST) AS rn FROM pred) WHERE rn = 1",
        "pred",
    ),
)
def _(spark, sf):
    return geo.dedup_predictions(pred(spark, sf)).select("fltyid", "bldgdmgpct", "depth_grid")


# blocks of every second order only, so that some results stay unmatched
b.cte("blocks", "SELECT fltyid, max(cbfips) AS cbfips FROM pred WHERE CAST(split_part(fltyid, '-', 1) AS BIGINT) % 2 = 0 GROUP BY 1", "pred")


def blocks(spark, sf):
    df = pred(spark, sf).where("CAST(split_part(fltyid, '-', 1) AS BIGINT) % 2 = 0")
    return df.groupBy("fltyid").agg(F.max("cbfips").alias("cbfips"))


@query(
    "joi04_attach_blocks",
    sql(
        "SELECT substr(k.cbfips, 1, 5) AS county, count(*) AS n, round(sum(bldgdmgpct), 2) AS pct FROM pred p LEFT JOIN blocks k ON k.fltyid = p.fltyid GROUP BY 1",
        "pred",
        "blocks",
    ),
)
def _(spark, sf):
    joined = geo.attach_blocks(pred(spark, sf).drop("cbfips"), blocks(spark, sf))
    return joined.groupBy(F.substring("cbfips", 1, 5).alias("county")).agg(F.count("*").alias("n"), F.round(F.sum("bldgdmgpct"), 2).alias("pct"))


@query(
    "joi04_matched_rate",
    sql(
        "SELECT count(*) AS total, count(k.cbfips) AS matched, round(count(k.cbfips) * CAST(100 AS DOUBLE) / greatest(count(*), 1), 1) AS matched_pct "
        "FROM pred p LEFT JOIN blocks k ON k.fltyid = p.fltyid",
        "pred",
        "blocks",
    ),
)
def _(spark, sf):
    return geo.matched_rate(geo.attach_blocks(pred(spark, sf).drop("cbfips"), blocks(spark, sf)), "cbfips")


COUNTS = "count(fltyid) AS Total_Num_Building, " + ", ".join(
    f"count(*) FILTER (WHERE damage_category = '{s}') AS Total_Num_Building_{s}" for s in LABELS
)
for _geo in ("county", "tract"):
    b.cte(
        f"areas_{_geo}",
        f"SELECT substr({_geo}_geoid, 1, 2) AS State_FIPS, substr({_geo}_geoid, 1, 5) AS County_FIPS, {_geo}_geoid AS FIPS, {COUNTS} FROM homes GROUP BY ALL",
        "homes",
    )
GEOGRAPHY = {"county": "county", "tract": "census tract"}


def areas(spark, sf, kind="county"):
    return geo.damage_counts(homes(spark, sf), LABELS, GEOGRAPHY[kind])


for _geo in ("county", "tract"):

    @query(f"agg03_damage_counts_{_geo}", sql(f"SELECT * FROM areas_{_geo}", f"areas_{_geo}"))
    def _(spark, sf, kind=_geo):
        return areas(spark, sf, kind)


@query("srt02_by_fips", sql("SELECT FIPS, Total_Num_Building FROM areas_tract ORDER BY FIPS", "areas_tract"))
def _(spark, sf):
    return geo.by_fips(areas(spark, sf, "tract")).select("FIPS", "Total_Num_Building")


@query(
    "agg04_imp01_category_distribution",
    sql(
        "SELECT damage_category, count(*) AS n, round(count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM homes), 1) AS pct FROM homes GROUP BY 1",
        "homes",
    ),
)
def _(spark, sf):
    return geo.category_distribution(homes(spark, sf))


@query("agg08_distinct_geographies", sql("SELECT count(DISTINCT county_geoid) AS counties, count(DISTINCT tract_geoid) AS tracts FROM homes", "homes"))
def _(spark, sf):
    return geo.distinct_geographies(homes(spark, sf))


b.cte("sketched", "SELECT concat('E', right(fltyid, 1)) AS event, county_geoid, tract_geoid, fltyid FROM homes", "homes")


@query(
    "agg08_stored_sketches",
    sql(
        "SELECT event, count(DISTINCT county_geoid) AS counties, count(DISTINCT tract_geoid) AS tracts, count(DISTINCT fltyid) AS buildings, true AS close "
        "FROM (SELECT * FROM sketched UNION ALL SELECT 'all', county_geoid, tract_geoid, fltyid FROM sketched) GROUP BY 1",
        "sketched",
    ),
)
def _(spark, sf):
    """Sketches per event, stored and merged, against the exact counts: within four standard errors."""
    rows = homes(spark, sf).withColumn("event", F.concat(F.lit("E"), F.substring("fltyid", -1, 1)))
    path = scratch_dir(spark)
    geo.geography_sketches(rows, ["event"]).write.parquet(path)
    stored = spark.read.parquet(path)
    names = {"county_geoid": "counties", "tract_geoid": "tracts", "fltyid": "buildings"}
    guessed = geo.count_sketches(stored, ["event"]).unionByName(geo.count_sketches(stored).withColumn("event", F.lit("all")))
    exact = rows.rollup("event").agg(*[F.countDistinct(c).alias(n) for c, n in names.items()]).withColumn("event", F.coalesce("event", F.lit("all")))
    close = F.lit(True)
    for c, n in names.items():
        close = close & (F.abs(F.col(f"n_{c}") - F.col(n)) <= F.greatest(F.lit(0.5), F.col(n) * 4 * geo.sketch_error()))
    return exact.join(guessed, "event", "left").select("event", *names.values(), F.coalesce(close, F.lit(False)).alias("close"))


@query(
    "joi05_join_svi",
    sql("SELECT a.*, s.ST_ABBR, s.COUNTY, s.E_TOTPOP, s.EP_POV150 FROM areas_county a LEFT JOIN svi s ON s.FIPS = a.FIPS", "areas_county", "svi"),
)
def _(spark, sf):
    joined = geo.join_svi(areas(spark, sf), b.svi(spark, sf))
    return joined.select(*areas(spark, sf).columns, "ST_ABBR", "COUNTY", "E_TOTPOP", "EP_POV150")


# names known for some tracts only
b.cte(
    "named",
    "SELECT State_FIPS, County_FIPS, FIPS, CASE WHEN CAST(substr(FIPS, 6) AS BIGINT) % 7 = 3 AND CAST(County_FIPS AS BIGINT) % 5 <> 1 "
    "THEN concat('S', State_FIPS) END AS ST_ABBR, CASE WHEN CAST(substr(FIPS, 6) AS BIGINT) % 7 = 3 AND CAST(County_FIPS AS BIGINT) % 5 <> 1 "
    "THEN concat('C', FIPS) END AS COUNTY FROM areas_tract WHERE FIPS IS NOT NULL",
    "areas_tract",
)


def named(spark, sf):
    known = "CAST(substr(FIPS, 6) AS BIGINT) % 7 = 3 AND CAST(County_FIPS AS BIGINT) % 5 <> 1"
    return areas(spark, sf, "tract").where("FIPS IS NOT NULL").selectExpr(
        "State_FIPS",
        "County_FIPS",
        "FIPS",
        f"CASE WHEN {known} THEN concat('S', State_FIPS) END AS ST_ABBR",
        f"CASE WHEN {known} THEN concat('C', FIPS) END AS COUNTY",
    )


def _filled(column, backward):
    forward = f"last_value({column} IGNORE NULLS) OVER (PARTITION BY State_FIPS, County_FIPS ORDER BY FIPS ROWS UNBOUNDED PRECEDING)"
    if backward == "county":
        nxt = f"first_value({column} IGNORE NULLS) OVER (PARTITION BY State_FIPS, County_FIPS ORDER BY FIPS ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    else:
        nxt = f"first_value({column} IGNORE NULLS) OVER (ORDER BY FIPS ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return f"coalesce({forward}, {nxt}) AS {column}"


for _back in ("county", "global"):

    @query(
        f"win02_fill_names_{_back}",
        sql(f"SELECT State_FIPS, County_FIPS, FIPS, {_filled('ST_ABBR', _back)}, {_filled('COUNTY', _back)} FROM named", "named"),
    )
    def _(spark, sf, back=_back):
        return geo.fill_names(named(spark, sf), backward=back)


FINAL_SVI = ", ".join(f"s.{c}" for c in fixed.FINAL_SVI_COLUMNS)
b.cte(
    "final",
    f"SELECT s.ST_ABBR, s.COUNTY, a.*, {FINAL_SVI} FROM areas_county a LEFT JOIN svi s ON s.FIPS = a.FIPS",
    "areas_county",
    "svi",
)


def final(spark, sf):
    return geo.final_output(geo.fill_names(geo.join_svi(areas(spark, sf), b.svi(spark, sf))), LABELS)


@query("imp12_final_output", sql("SELECT * FROM final", "final"))
def _(spark, sf):
    return final(spark, sf)


@query(
    "agg05_overview",
    sql(
        "SELECT coalesce(sum(E_TOTPOP), 0) AS total_population, count(*) AS areas, "
        + ", ".join(
            f"CAST(sum(Total_Num_Building_{s}) AS BIGINT) AS n_{s}, round(sum(Total_Num_Building_{s}) * CAST(100 AS DOUBLE) / greatest(sum(Total_Num_Building), 1), 1) AS pct_{s}"
            for s in LABELS
        )
        + " FROM final",
        "final",
    ),
)
def _(spark, sf):
    return geo.overview(final(spark, sf), LABELS)


@query(
    "imp11_worst_damage",
    sql("SELECT FIPS, Total_Num_Building_Destroyed + Total_Num_Building_Major AS worst_damage_assessment FROM final", "final"),
)
def _(spark, sf):
    return geo.worst_damage(final(spark, sf), LABELS).select("FIPS", "worst_damage_assessment")


@query(
    "joi09_join_boundaries",
    sql("SELECT x.GEOID, x.n_name, f.Total_Num_Building FROM (SELECT concat('12', lpad(CAST(n_nationkey AS VARCHAR), 3, '0')) AS GEOID, n_name FROM nation) x JOIN final f ON f.FIPS = x.GEOID", "final"),
)
def _(spark, sf):
    bounds = b.table(spark, sf, "nation").selectExpr("concat('12', lpad(CAST(n_nationkey AS STRING), 3, '0')) AS GEOID", "n_name")
    return geo.join_boundaries(final(spark, sf), bounds).select("GEOID", "n_name", "Total_Num_Building")


# --- classification and population --------------------------------------------------
@query("imp02_intensity_zone", sql("SELECT zone, count(*) AS n, max(depth_grid) AS depth, max(bldgdmgpct) AS pct FROM homes GROUP BY 1", "homes"))
def _(spark, sf):
    return homes(spark, sf).groupBy("zone").agg(F.count("*").alias("n"), F.max("depth_grid").alias("depth"), F.max("bldgdmgpct").alias("pct"))


@query("imp03_damage_state", sql("SELECT damage_state, count(*) AS n, min(bldgdmgpct) AS lo, max(bldgdmgpct) AS hi FROM homes GROUP BY 1", "homes"))
def _(spark, sf):
    return homes(spark, sf).groupBy("damage_state").agg(F.count("*").alias("n"), F.min("bldgdmgpct").alias("lo"), F.max("bldgdmgpct").alias("hi"))


SHARES = {s: f"avg(CASE WHEN damage_state = '{s}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)" for s in ("Slight", "Moderate", "Extensive", "Complete")}
b.cte(
    "tracts",
    "SELECT *, CASE WHEN pct_destroyed >= 35 THEN 'HIGH' WHEN pct_destroyed >= 11 THEN 'MEDIUM' ELSE 'LOW' END AS severity FROM (SELECT tract_geoid, count(*) AS n_buildings, "
    + ", ".join(f"{v} AS frac_{k.lower()}" for k, v in SHARES.items())
    + f", {SHARES['Complete']} * 100 AS pct_destroyed, {SHARES['Extensive']} * 100 AS pct_major, max(depth_grid) AS max_intensity FROM homes GROUP BY 1)",
    "homes",
)
TRACT_DOUBLES = ["frac_slight", "frac_moderate", "frac_extensive", "frac_complete", "pct_destroyed", "pct_major"]


def tracts(spark, sf):
    return pop.with_severity(pop.tract_severity_inputs(homes(spark, sf)))


@query(
    "agg10_imp04_tract_severity",
    sql("SELECT tract_geoid, n_buildings, " + ", ".join(f"round({c}, 6) AS {c}" for c in TRACT_DOUBLES) + ", max_intensity, severity FROM tracts", "tracts"),
)
def _(spark, sf):
    return tracts(spark, sf).select("tract_geoid", "n_buildings", *[F.round(c, 6).alias(c) for c in TRACT_DOUBLES], "max_intensity", "severity")


def zone_sql(test, name):
    return ", ".join(
        f"count(*) FILTER (WHERE {test} AND zone = '{z}') * CAST('2.53' AS DOUBLE) AS pop_{name}_{z.lower()}" for z in fixed.ZONES
    )


b.cte(
    "zones",
    f"SELECT event, county_geoid, {zone_sql('depth_grid > 0', 'affected')}, {zone_sql('depth_grid > 0 AND bldgdmgpct > 15', 'impacted')} FROM homes GROUP BY 1, 2",
    "homes",
)
POPS = [f"pop_{n}_{z.lower()}" for n in ("affected", "impacted") for z in fixed.ZONES]


def zones(spark, sf):
    return pop.population_by_zone(homes(spark, sf), damage_threshold=15)


@query("agg09_imp05_population_by_zone", sql("SELECT event, county_geoid, " + ", ".join(f"round({c}, 4) AS {c}" for c in POPS) + " FROM zones", "zones"))
def _(spark, sf):
    return zones(spark, sf).select("event", "county_geoid", *[F.round(c, 4).alias(c) for c in POPS])


@query(
    "agg09_population_long",
    sql(
        " UNION ALL ".join(
            f"SELECT event, county_geoid, '{z}' AS zone, round(pop_affected_{z.lower()}, 4) AS pop_affected, round(pop_impacted_{z.lower()}, 4) AS pop_impacted "
            f"FROM zones WHERE pop_affected_{z.lower()} > 0 OR pop_impacted_{z.lower()} > 0"
            for z in fixed.ZONES
        ),
        "zones",
    ),
)
def _(spark, sf):
    long = pop.population_long(zones(spark, sf))
    return long.select("event", "county_geoid", "zone", *[F.round(c, 4).alias(c) for c in ("pop_affected", "pop_impacted")])


NEEDS = {
    f"hh_{n}_{z.lower()}": f"CAST(round_even(pop_impacted_{z.lower()} * CAST('{rates[z]}' AS DOUBLE), 0) AS BIGINT)"
    for n, rates in (("shelter", fixed.SHELTER_RATE), ("feeding", fixed.FEEDING_RATE))
    for z in fixed.ZONES
}
b.cte("demand", "SELECT *, hh_shelter_low + hh_shelter_medium + hh_shelter_high AS total_shelter_est FROM (SELECT *, "
      + ", ".join(f"{e} AS {c}" for c, e in NEEDS.items()) + " FROM zones)", "zones")


def demand(spark, sf):
    return pop.mass_care_demand(zones(spark, sf))


@query("imp06_mass_care", sql("SELECT event, county_geoid, " + ", ".join(NEEDS) + ", total_shelter_est FROM demand", "demand"))
def _(spark, sf):
    return demand(spark, sf).select("event", "county_geoid", *NEEDS, "total_shelter_est")


# made-up usability and shelter shares
UTILITY = [(d, u, v) for d, row in {"Slight": (0.8, 0.15, 0.05), "Moderate": (0.5, 0.3, 0.2), "Extensive": (0.2, 0.4, 0.4), "Complete": (0.0, 0.1, 0.9)}.items()
           for u, v in zip(("FU", "PU", "NU"), row)]
SHELTER = [(r, u, v) for r, row in {"LOW": (0.0, 0.2), "MEDIUM": (0.1, 0.4), "HIGH": (0.2, 0.6)}.items() for u, v in zip(("FU", "PU"), row)]
b.cte("utility", b.values(UTILITY, "damage_state, usability, u"))
b.cte("shelter", b.values(SHELTER, "severity, usability, s"))
b.cte(
    "bhi",
    "SELECT t.tract_geoid, sum(t.frac * u.u * CASE WHEN u.usability = 'NU' THEN 1.0::DOUBLE ELSE s.s END) AS bhi_factor FROM ("
    + " UNION ALL ".join(f"SELECT tract_geoid, severity, '{k}' AS damage_state, frac_{k.lower()} AS frac FROM tracts" for k in SHARES)
    + ") t JOIN utility u ON u.damage_state = t.damage_state LEFT JOIN shelter s ON s.severity = t.severity AND s.usability = u.usability GROUP BY 1",
    "tracts",
    "utility",
    "shelter",
)


def bhi(spark, sf):
    utility = b.literal_rows(spark, UTILITY, "damage_state, usability, u")
    shelter = b.literal_rows(spark, SHELTER, "severity, usability, s")
    return pop.habitability(tracts(spark, sf).where("tract_geoid IS NOT NULL"), utility, shelter)


@query("imp07_bhi_factor", sql("SELECT tract_geoid, round(bhi_factor, 6) AS bhi_factor FROM bhi WHERE tract_geoid IS NOT NULL", "bhi"))
def _(spark, sf):
    return bhi(spark, sf).select("tract_geoid", F.round("bhi_factor", 6).alias("bhi_factor"))


# census people and rank per tract, missing for some
CENSUS = {
    "tract_geoid": "concat(CASE WHEN l_linenumber % 2 = 0 THEN '01' ELSE '12' END, lpad(CAST(l_suppkey % 30 AS STRING), 3, '0'), lpad(CAST(l_partkey % 45 AS STRING), 6, '0'))",
    "q": "l_quantity",
    "k": "l_partkey % 45",
}
b.cte(
    "census",
    "SELECT tract_geoid, sum(q) * CAST('1.0123457' AS DOUBLE) AS population, CAST(max(k) AS DOUBLE) / 44 AS svi_rank FROM (" + b.select(CENSUS, "lineitem") + ") GROUP BY 1",
)


def census(spark, sf):
    keyed = b.project(b.table(spark, sf, "lineitem"), CENSUS)
    return keyed.groupBy("tract_geoid").agg((F.sum("q") * 1.0123457).alias("population"), (F.max("k").cast("double") / 44).alias("svi_rank"))


SVI_RATE = "CASE WHEN svi_rank < 0.4 THEN 0.0::DOUBLE WHEN svi_rank < 0.8 THEN 0.025::DOUBLE WHEN svi_rank <= 1.0 THEN 0.05::DOUBLE END"


@query(
    "joi12_join_population",
    sql(
        "SELECT t.tract_geoid, t.n_buildings, c.population, round(c.svi_rank, 6) AS svi_rank FROM tracts t LEFT JOIN census c ON c.tract_geoid = t.tract_geoid",
        "tracts",
        "census",
    ),
)
def _(spark, sf):
    joined = pop.join_population(tracts(spark, sf), census(spark, sf))
    return joined.select("tract_geoid", "n_buildings", "population", F.round("svi_rank", 6).alias("svi_rank"))


@query(
    "imp08_imp09_shelter_demand",
    sql(
        f"SELECT b.tract_geoid, {SVI_RATE} AS svi_rate, round(population * (bhi_factor * 0.5::DOUBLE) * {SVI_RATE}, 6) AS shelter_low, "
        f"round(population * bhi_factor * {SVI_RATE}, 6) AS shelter_high FROM bhi b LEFT JOIN census c ON c.tract_geoid = b.tract_geoid WHERE b.tract_geoid IS NOT NULL",
        "bhi",
        "census",
    ),
)
def _(spark, sf):
    df = pop.join_population(bhi(spark, sf), census(spark, sf))
    both = df.withColumns({"bhi_low": F.col("bhi_factor") * 0.5, "bhi_high": F.col("bhi_factor")})
    out = pop.shelter_demand(both)
    return out.select("tract_geoid", "svi_rate", F.round("shelter_low", 6).alias("shelter_low"), F.round("shelter_high", 6).alias("shelter_high"))


@query(
    "agg15_displaced_population",
    sql(
        "SELECT county_geoid, time_of_day, age_band, round(displaced, 4) AS displaced FROM (SELECT county_geoid, unnest(['night', 'night', 'day', 'day']) AS time_of_day, "
        "unnest(['under65', 'over65', 'under65', 'over65']) AS age_band, unnest([sum(pop2amu65 * bldgdmgpct / 100), sum(pop2amo65 * bldgdmgpct / 100), "
        "sum(pop2pmu65 * bldgdmgpct / 100), sum(pop2pmo65 * bldgdmgpct / 100)]) AS displaced FROM homes GROUP BY 1)",
        "homes",
    ),
)
def _(spark, sf):
    out = pop.displaced_population(homes(spark, sf), ["county_geoid"], F.col("bldgdmgpct") / 100)
    return out.withColumn("displaced", F.round("displaced", 4))


@query(
    "agg16_imp10_flat_shelter_high_need",
    sql(
        "SELECT county_geoid, round(d * 0.0073::DOUBLE, 4) AS shelter_flat, round(d * CASE WHEN county_geoid < '05' THEN 0.3::DOUBLE ELSE 0.6::DOUBLE END, 4) AS high_need "
        "FROM (SELECT county_geoid, sum(pop2amu65 * bldgdmgpct / 100) AS d FROM homes GROUP BY 1)",
        "homes",
    ),
)
def _(spark, sf):
    wide = homes(spark, sf).groupBy("county_geoid").agg(F.sum(F.col("pop2amu65") * F.col("bldgdmgpct") / 100).alias("displaced"))
    weight = F.when(F.col("county_geoid") < "05", F.lit(0.3)).otherwise(F.lit(0.6))
    out = pop.high_need_population(pop.flat_shelter(wide), "displaced", weight)
    return out.select("county_geoid", F.round("shelter_flat", 4).alias("shelter_flat"), F.round("high_need", 4).alias("high_need"))


@query("agg17_runs_by_event", sql("SELECT event, adv, count(*) AS n_rows FROM pred GROUP BY 1, 2", "pred"))
def _(spark, sf):
    return pop.runs_by_event(pred(spark, sf))


@query(
    "agg17_runs_range",
    sql("SELECT event, count(*) AS advisories, min(n) AS min_rows, max(n) AS max_rows FROM (SELECT event, adv, count(*) AS n FROM pred GROUP BY 1, 2) GROUP BY 1", "pred"),
)
def _(spark, sf):
    return pop.runs_range(pred(spark, sf))


VARIANTS = [(n, *t) for n, t in fixed.THRESHOLD_VARIANTS.items()]
b.cte("variants", b.values(VARIANTS, "variant, lo, mid, hi"))


@query(
    "agg13_threshold_sensitivity",
    sql(
        "SELECT event, variant, z.zone AS zone, count(h.fltyid) AS n_buildings FROM (SELECT DISTINCT event FROM homes) e CROSS JOIN variants v CROSS JOIN "
        "(SELECT unnest(['LOW', 'MEDIUM', 'HIGH', 'NONE']) AS zone) z LEFT JOIN (SELECT fltyid, event, depth_grid, bldgdmgpct FROM homes) h ON h.event = e.event AND z.zone = "
        "CASE WHEN depth_grid > hi THEN 'HIGH' WHEN depth_grid >= mid THEN 'MEDIUM' WHEN depth_grid >= lo THEN 'LOW' WHEN bldgdmgpct > 40 THEN 'HIGH' "
        "WHEN bldgdmgpct > 20 THEN 'MEDIUM' WHEN bldgdmgpct > 0 THEN 'LOW' ELSE 'NONE' END GROUP BY e.event, variant, z.zone".replace("SELECT event,", "SELECT e.event,"),
        "homes",
        "variants",
    ),
)
def _(spark, sf):
    return pop.threshold_sensitivity(homes(spark, sf), keys=["event"], damage_delta=5)


FLOW_RATES = [(z, fixed.IMPACT_RATE_EXAMPLE[z], fixed.SHELTER_RATE[z], fixed.FEEDING_RATE[z]) for z in fixed.ZONES]
b.cte("flow_rates", b.values(FLOW_RATES, "zone, impacted_rate, shelter_rate, feeding_rate"))
b.cte(
    "flow",
    "SELECT FIPS AS county, z.zone, E_TOTPOP AS population, EP_HBURD AS pct_affected, z.share AS zone_share FROM svi CROSS JOIN "
    "(SELECT * FROM (VALUES ('LOW', 0.5::DOUBLE), ('MEDIUM', 0.3::DOUBLE), ('HIGH', 0.2::DOUBLE)) t(zone, share)) z",
    "svi",
)


@query(
    "imp16_population_flow",
    sql(
        "SELECT county, zone, round(a, 4) AS affected, round(a * impacted_rate, 4) AS impacted, round(a * impacted_rate * shelter_rate, 4) AS shelter, "
        "round(a * impacted_rate * feeding_rate, 4) AS feeding FROM (SELECT *, population * pct_affected / 100 * zone_share AS a FROM flow JOIN flow_rates USING (zone))",
        "flow",
        "flow_rates",
    ),
)
def _(spark, sf):
    zoned = b.svi(spark, sf).selectExpr(
        "FIPS AS county",
        "E_TOTPOP AS population",
        "EP_HBURD AS pct_affected",
        "stack(3, 'LOW', 0.5D, 'MEDIUM', 0.3D, 'HIGH', 0.2D) AS (zone, zone_share)",
    )
    rates = b.literal_rows(spark, FLOW_RATES, "zone, impacted_rate, shelter_rate, feeding_rate")
    cols = ("affected", "impacted", "shelter", "feeding")
    return pop.population_flow(zoned, rates).select("county", "zone", *[F.round(c, 4).alias(c) for c in cols])


# --- validation ----------------------------------------------------------------------
SUMMARY = "count(*) AS n_rows, count(*) FILTER (WHERE bldgdmgpct <= 0) AS zero_loss_rows, round(100.0::DOUBLE * count(*) FILTER (WHERE bldgdmgpct <= 0) / count(*), 2) AS zero_loss_pct, round(sum(bldgdmgpct), 2) AS loss"
b.cte(
    "summary",
    " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, {k} AS key, {SUMMARY} FROM pred" + ("" if d == "total" else " GROUP BY 2")
        for d, k in (("total", "NULL::VARCHAR"), ("state", "state"), ("flc", "flc"), ("occ", "coalesce(occ, '')"))
    ),
    "pred",
)


def result_file(spark, sf):
    """Result columns under their file names, losses as text, as a CSV reader gives them."""
    return pred(spark, sf).selectExpr(
        "fltyid AS FltyId", "0.0D AS Latitude", "0.0D AS Longitude", "state", "flc", "occ AS Occ", "CAST(bldgdmgpct AS STRING) AS BldgDmgPct", "'' AS BldgLoss"
    )


@query("agg06_prediction_summary", sql("SELECT * FROM summary", "summary"))
def _(spark, sf):
    return val.prediction_summary(result_file(spark, sf))


@query("top01_top_occupancies", sql("SELECT key AS occ, n_rows FROM summary WHERE dimension = 'occ' ORDER BY n_rows DESC, key LIMIT 10", "summary"))
def _(spark, sf):
    return val.top_occupancies(val.prediction_summary(result_file(spark, sf)))


@query(
    "agg07_validation_checks",
    sql(
        "SELECT n_rows AS total_rows, zero_loss_pct, CASE WHEN zero_loss_pct > 90 THEN concat('WARN: ', zero_loss_pct, '% zero-loss rows') ELSE '' END AS issues, true AS passed FROM summary WHERE dimension = 'total'",
        "summary",
    ),
)
def _(spark, sf):
    checks = val.validation_checks(val.prediction_summary(result_file(spark, sf)))
    return checks.withColumn("issues", F.array_join("issues", "; "))


REPORT_SQL = " UNION ALL ".join(
    [f"SELECT 'total' AS section, '{n}' AS key, CAST({c} AS DOUBLE) AS value FROM summary WHERE dimension = 'total'" for n, c in (("total_rows", "n_rows"), ("zero_loss_rows", "zero_loss_rows"), ("zero_loss_pct", "zero_loss_pct"), ("passed", "1"), ("issues", "CASE WHEN zero_loss_pct > 90 THEN 1 ELSE 0 END"))]
    + [f"SELECT '{n}', key, CAST({c} AS DOUBLE) FROM summary WHERE dimension = '{d}'" for n, d, c in (("rows_by_state", "state", "n_rows"), ("rows_by_flc", "flc", "n_rows"), ("damage_by_state", "state", "coalesce(loss, 0)"))]
    + ["SELECT 'rows_by_occ_top10', key, CAST(n_rows AS DOUBLE) FROM (SELECT key, n_rows FROM summary WHERE dimension = 'occ' ORDER BY n_rows DESC, key LIMIT 10)", "SELECT 'file', 'results.csv', NULL"]
)


@query("snk09_validation_report", sql(REPORT_SQL, "summary"))
def _(spark, sf):
    """Every field of the written report, one row each."""
    path = scratch_dir(spark)
    writers.write_validation_report(result_file(spark, sf), path, file="results.csv")
    maps = ["rows_by_state", "rows_by_flc", "rows_by_occ_top10", "damage_by_state"]
    fields = ", ".join(["total_rows: bigint", "zero_loss_rows: bigint", "zero_loss_pct: double", *[f"{m}: map<string, double>" for m in maps]])
    r = spark.read.text(path).select(F.from_json("value", f"file string, summary struct<{fields}>, issues array<string>, passed boolean").alias("r")).select("r.*")

    def field(section, key, value):
        return F.struct(F.lit(section).alias("section"), key.alias("key"), value.cast("double").alias("value"))

    single = [field("total", F.lit(n), F.col(f"summary.{n}")) for n in ("total_rows", "zero_loss_rows", "zero_loss_pct")]
    single += [field("total", F.lit("passed"), F.col("passed").cast("int")), field("total", F.lit("issues"), F.size("issues")), field("file", F.col("file"), F.lit(None))]

    def entries(name):
        return F.transform(F.map_entries(f"summary.{name}"), lambda e: field(name, e["key"], e["value"]))

    many = [entries(m) for m in maps]
    return r.select(F.inline(F.concat(F.array(*single), *many)))


# estimates and records per event and county; some pairs exist on one side only
TRUTH = {
    "event": "concat('E', o_orderstatus)",
    "state": "concat('S', CAST(o_custkey % 7 AS STRING))",
    "county": "concat(CASE WHEN o_custkey % 90 < 80 THEN 'C' ELSE 'R' END, CAST(o_custkey % 90 AS STRING))",
    "planned": "CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE floor(o_totalprice / 5000) END",
    "actual": "CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE floor(o_totalprice / 3000) END",
}
# each side has some counties of its own
ESTIMATED = {**TRUTH, "county": "concat(CASE WHEN o_custkey % 90 > 8 THEN 'C' ELSE 'E' END, CAST(o_custkey % 90 AS STRING))"}
KEYS = ["event", "state", "county"]
b.cte("truth", "SELECT event, state, county, CAST(sum(planned) AS DOUBLE) AS planned_shelter, CAST(sum(actual) AS DOUBLE) AS actual_shelter FROM ("
      + b.select(TRUTH, "orders") + ") GROUP BY 1, 2, 3")
b.cte("target", "SELECT *, coalesce(actual_shelter, planned_shelter) AS shelter_pop FROM truth", "truth")
b.cte("estimate", "SELECT event, state, county, CAST(count(*) * 40 AS DOUBLE) AS estimate FROM ("
      + b.select(ESTIMATED, "orders") + ") GROUP BY 1, 2, 3")


def truth(spark, sf):
    rows = b.project(b.table(spark, sf, "orders"), TRUTH)
    summed = rows.groupBy(*KEYS).agg(
        F.sum("planned").cast("double").alias("planned_shelter"), F.sum("actual").cast("double").alias("actual_shelter")
    )
    return pop.ground_truth_target(summed)


def estimate(spark, sf):
    rows = b.project(b.table(spark, sf, "orders"), ESTIMATED)
    return rows.groupBy(*KEYS).agg((F.count("*") * 40).cast("double").alias("estimate"))


def validated(spark, sf):
    return val.join_ground_truth(estimate(spark, sf), truth(spark, sf), KEYS)


b.cte("validated", "SELECT e.event, e.state, e.county, estimate, planned_shelter, actual_shelter, shelter_pop FROM estimate e JOIN target t ON e.event = t.event AND e.state = t.state AND e.county = t.county", "estimate", "target")


@query("imp13_ground_truth_target", sql("SELECT * FROM target", "target"))
def _(spark, sf):
    return truth(spark, sf)


@query("joi11_join_ground_truth", sql("SELECT * FROM validated", "validated"))
def _(spark, sf):
    return validated(spark, sf)


METRICS = ["rmse", "mae", "r2", "mean_truth", "mean_estimate"]


@query(
    "agg11_accuracy_metrics",
    sql(
        "SELECT event, n, round(sqrt(sse / n), 4) AS rmse, round(sae / n, 4) AS mae, round(1 - sse / (gg - g * g / n), 4) AS r2, round(g / n, 4) AS mean_truth, "
        "round(e / n, 4) AS mean_estimate FROM (SELECT event, count(*) AS n, sum((estimate - shelter_pop) * (estimate - shelter_pop)) AS sse, sum(abs(estimate - shelter_pop)) AS sae, "
        "sum(shelter_pop) AS g, sum(shelter_pop * shelter_pop) AS gg, sum(estimate) AS e FROM validated WHERE shelter_pop IS NOT NULL GROUP BY ROLLUP (event))",
        "validated",
    ),
)
def _(spark, sf):
    out = val.accuracy_metrics(validated(spark, sf), "shelter_pop", "estimate")
    return out.select("event", "n", *[F.round(c, 4).alias(c) for c in METRICS])


@query(
    "joi10_coverage",
    sql(
        "SELECT t.event, t.state, t.county, e.event IS NOT NULL AS matched FROM truth t LEFT JOIN estimate e ON e.event = t.event AND e.state = t.state AND e.county = t.county",
        "truth",
        "estimate",
    ),
)
def _(spark, sf):
    return val.coverage(estimate(spark, sf), truth(spark, sf))


@query(
    "agg12_coverage_rate",
    sql(
        "SELECT event, state, matched, gt_total, round(matched / gt_total, 6) AS coverage_rate FROM (SELECT t.event, t.state, count(e.event) AS matched, count(*) AS gt_total "
        "FROM truth t LEFT JOIN estimate e ON e.event = t.event AND e.state = t.state AND e.county = t.county GROUP BY 1, 2)",
        "truth",
        "estimate",
    ),
)
def _(spark, sf):
    out = val.coverage_rate(val.coverage(estimate(spark, sf), truth(spark, sf)))
    return out.withColumn("coverage_rate", F.round("coverage_rate", 6))


@query("set04_matched_counties", sql("SELECT event, state, county FROM estimate INTERSECT SELECT event, state, county FROM truth", "estimate", "truth"))
def _(spark, sf):
    return val.matched_counties(estimate(spark, sf), truth(spark, sf), KEYS)


@query("set04_missed_counties", sql("SELECT event, state, county FROM truth EXCEPT SELECT event, state, county FROM estimate", "estimate", "truth"))
def _(spark, sf):
    return val.missed_counties(estimate(spark, sf), truth(spark, sf), KEYS)


@query(
    "top02_largest_errors",
    sql(
        "SELECT event, state, county, shelter_pop, estimate, abs(estimate - shelter_pop) AS abs_error, CASE WHEN estimate > shelter_pop THEN 'OVER' ELSE 'UNDER' END AS direction "
        "FROM validated ORDER BY abs_error DESC NULLS LAST, event, state, county LIMIT 10",
        "validated",
    ),
)
def _(spark, sf):
    return val.largest_errors(validated(spark, sf), "shelter_pop", "estimate", KEYS)


@query("top03_top_counties", sql("SELECT event, state, county, shelter_pop, estimate FROM validated ORDER BY shelter_pop DESC NULLS LAST, event, state, county LIMIT 15", "validated"))
def _(spark, sf):
    return val.top_counties(validated(spark, sf), "shelter_pop", KEYS, ["estimate"])


SANE = [f"pop_impacted_{z} <= pop_affected_{z}" for z in ("low", "medium", "high")] + ["zero affected has zero impacted", "affected <= county population"]
AFFECTED, IMPACTED = (" + ".join(f"pop_{n}_{z}" for z in ("low", "medium", "high")) for n in ("affected", "impacted"))
SANE_TESTS = [f"pop_impacted_{z} > pop_affected_{z} + 1e-9" for z in ("low", "medium", "high")] + [
    f"{AFFECTED} = 0 AND {IMPACTED} > 0",
    f"{AFFECTED} > E_TOTPOP + 1e-9",
]


@query(
    "agg14_sanity_checks",
    sql(
        "SELECT check_name, violations, CASE WHEN violations = 0 THEN 'OK' ELSE 'ERROR' END AS severity FROM ("
        + " UNION ALL ".join(
            f"SELECT '{n}' AS check_name, count(*) FILTER (WHERE {t}) AS violations FROM zones z JOIN svi s ON s.FIPS = z.county_geoid" for n, t in zip(SANE, SANE_TESTS)
        )
        + ")",
        "zones",
        "svi",
    ),
)
def _(spark, sf):
    people = b.svi(spark, sf).selectExpr("FIPS AS county_geoid", "E_TOTPOP AS census_pop")
    return val.sanity_checks(zones(spark, sf).join(people, "county_geoid"))


# --- end to end -----------------------------------------------------------------------
b.cte(
    "run_best",
    f"SELECT *, {CATEGORY.replace('depth_grid', 'Depth_Grid')} AS damage_category, substr(k, 1, 5) AS county_geoid FROM (SELECT *, CASE WHEN length(cbfips) < 15 "
    "THEN lpad(cbfips, 15, '0') ELSE cbfips END AS k FROM (SELECT *, row_number() OVER (PARTITION BY FltyId ORDER BY BldgDmgPct DESC NULLS LAST, Depth_Grid DESC NULLS LAST, "
    f"Occ NULLS FIRST, cbfips NULLS FIRST) AS rn FROM res_sampled) WHERE rn = 1 AND Occ IN ({RES}))",
    "res_sampled",
)


@query(
    "imp15_end_to_end",
    sql(
        f"SELECT s.ST_ABBR, s.COUNTY, a.*, {FINAL_SVI} FROM (SELECT substr(county_geoid, 1, 2) AS State_FIPS, county_geoid AS County_FIPS, county_geoid AS FIPS, "
        f"{COUNTS.replace('count(fltyid)', 'count(FltyId)')} FROM run_best GROUP BY 1, 2, 3) a LEFT JOIN svi s ON s.FIPS = a.FIPS",
        "run_best",
        "svi",
    ),
)
def _(spark, sf):
    params = plan.RunParams.of({"categories": LABELS})
    return plan.run_impact(b.bldg(spark, sf), b.meta(spark, sf), b.pixels(spark, sf), b.lookups(spark), b.svi(spark, sf), params)


@query(
    "imp15_area_table",
    sql(
        f"SELECT s.ST_ABBR, s.COUNTY, a.*, {FINAL_SVI} FROM (SELECT substr(t, 1, 2) AS State_FIPS, substr(t, 1, 5) AS County_FIPS, t AS FIPS, {COUNTS} FROM "
        f"(SELECT fltyid, damage_category, substr(coalesce(cb, '000000000000nan'), 1, 5) AS t FROM (SELECT p.*, k.cbfips AS cb, {CATEGORY} AS damage_category FROM "
        "(SELECT fltyid, occ, depth_grid, bldgdmgpct FROM (SELECT *, row_number() OVER (PARTITION BY fltyid ORDER BY bldgdmgpct DESC, depth_grid DESC, occ NULLS FIRST) AS rn "
        f"FROM pred) WHERE rn = 1 AND occ IN ({RES})) p LEFT JOIN blocks k ON k.fltyid = p.fltyid)) GROUP BY 1, 2, 3) a LEFT JOIN svi s ON s.FIPS = a.FIPS",
        "pred",
        "blocks",
        "svi",
    ),
)
def _(spark, sf):
    return geo.area_table(
        pred(spark, sf), blocks(spark, sf), b.svi(spark, sf), LABELS, dict.fromkeys(fixed.RESIDENTIAL_TYPES, "Y"), "county", "nan_text"
    )


@query(
    "imp15_population_by_event",
    sql(
        "SELECT event, county_geoid, round(a, 4) AS pop_affected_low, h AS hh_shelter_high FROM (SELECT event, county_geoid, "
        "count(*) FILTER (WHERE depth_grid > 0 AND zone = 'LOW') * CAST('2.53' AS DOUBLE) AS a, "
        "CAST(round_even(count(*) FILTER (WHERE depth_grid > 0 AND bldgdmgpct > 0 AND zone = 'HIGH') * CAST('2.53' AS DOUBLE) * CAST('0.05' AS DOUBLE), 0) AS BIGINT) AS h FROM ("
        f"SELECT *, {ZONE} AS zone FROM (SELECT regexp_extract(GridName, '^(.+_[0-9]{{4}})_adv', 1) AS event, Depth_Grid AS depth_grid, BldgDmgPct AS bldgdmgpct, "
        "substr(CASE WHEN length(cbfips) < 15 THEN lpad(cbfips, 15, '0') ELSE cbfips END, 1, 5) AS county_geoid FROM res_sampled "
        f"WHERE Occ IN ({RES}))) GROUP BY 1, 2)",
        "res_sampled",
    ),
)
def _(spark, sf):
    results = plan.damage_by_raster(b.bldg(spark, sf), b.meta(spark, sf), b.pixels(spark, sf), b.lookups(spark))
    out = plan.run_population(results, fixed.RESIDENTIAL_TYPES)
    return out.select("event", "county_geoid", F.round("pop_affected_low", 4).alias("pop_affected_low"), "hh_shelter_high")
