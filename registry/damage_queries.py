"""Queries of the damage engine (DMG, JOI-2/3, FLT-5, SRC-6/7, SNK-4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import base as b
from registry.base import query, sql
from tidemark.functions import damage as fd
from tidemark.operators import curves as oc
from tidemark.operators import damage as od
from tidemark.operators import inventory as inv
from tidemark.plans import impact as plan
from tidemark.session import scratch_dir
from tidemark.sinks import writers

MAPPING = plan.ENGINE_MAPPING


def exposure(spark, sf):
    """Strict engine rows with the stand-in depth; repeated ids stay."""
    rows = inv.require_fields(b.bldg(spark, sf))
    return inv.engine_columns(rows, ["cbfips", "state", "depth", "user_curve"]).withColumnRenamed("depth", "depth_grid")


def assessed(spark, sf, flood="CoastalA", override="off", mapping=MAPPING, qc=False):
    df = exposure(spark, sf)
    rows = inv.apply_field_map(df, mapping).withColumn("raster_id", F.lit("stand-in"))
    keep = [c for c in df.columns if c != "depth_grid"]
    return od.assess(rows, keep, mapping, flood, b.lookups(spark), override, qc)


# losses have at most six decimals here, so decimal sums are exact in any order
def total(*names):
    return [F.sum(F.col(n).cast("decimal(24,6)")).cast("double").alias(n.lower()) for n in names]


def total_sql(*names):
    return ", ".join(f"CAST(sum(CAST({n} AS DECIMAL(24, 6))) AS DOUBLE) AS {n.lower()}" for n in names)


KEYED = "FROM keyed_exposure"


@query(
    "dmg01_depth_in_structure",
    sql(
        "SELECT FirstFloorHt AS height, count(*) AS n, min(din) AS lo, max(din) AS hi, round(sum(din), 4) AS total "
        f"{KEYED} GROUP BY 1",
        "keyed_exposure",
    ),
)
def _(spark, sf):
    din = fd.depth_in_structure(F.col("depth_grid"), F.col("FirstFloorHt"))
    return (
        exposure(spark, sf)
        .groupBy(F.col("FirstFloorHt").alias("height"))
        .agg(F.count("*").alias("n"), F.min(din).alias("lo"), F.max(din).alias("hi"), F.round(F.sum(din), 4).alias("total"))
    )


@query(
    "dmg02_specific_occupancy",
    sql(f"SELECT Occ, NumStories, FoundationType, soid, count(*) AS n {KEYED} GROUP BY ALL", "keyed_exposure"),
)
def _(spark, sf):
    soid = fd.specific_occupancy(F.col("Occ"), F.col("NumStories"), F.col("FoundationType"))
    return exposure(spark, sf).groupBy("Occ", "NumStories", "FoundationType", soid.alias("soid")).agg(F.count("*").alias("n"))


MULTIPLIER = (
    "CASE WHEN Occ IN ('RES1','RES2','RES3A','RES3B','RES3C','RES3D','RES3E','RES3F','RES4','RES5','RES6','COM10') THEN 0.5 "
    "WHEN Occ IN ('COM1','COM2','COM3','COM4','COM5','COM8','COM9','IND6','AGR1','REL1','GOV1','EDU1') THEN 1.0 "
    "WHEN Occ IN ('COM6','COM7','IND1','IND2','IND3','IND4','IND5','GOV2','EDU2') THEN 1.5 ELSE 0 END"
)


@query(
    "dmg03_content_cost",
    sql(
        f"SELECT Occ, round(sum(CAST(trunc(Cost) AS DOUBLE) * CAST({MULTIPLIER} AS DOUBLE)), 2) AS unmapped, "
        f"round(sum(trunc(ContentCost)), 2) AS mapped FROM exposure GROUP BY 1",
        "exposure",
    ),
)
def _(spark, sf):
    occ, cost = F.col("Occ"), F.col("Cost")
    return (
        exposure(spark, sf)
        .groupBy("Occ")
        .agg(
            F.round(F.sum(fd.content_cost(occ, cost)), 2).alias("unmapped"),
            F.round(F.sum(fd.content_cost(occ, cost, F.col("ContentCost"))), 2).alias("mapped"),
        )
    )


@query(
    "dmg04_inventory_cost",
    sql(
        "SELECT Occ, round(sum(CASE WHEN Occ IN ('COM1','COM2','IND1','IND2','IND3','IND4','IND5','IND6','AGR1') "
        "THEN coalesce(per_sqft * pct * Area / 100, 0) ELSE 0 END), 2) AS default_cost, "
        "round(sum(CASE WHEN ContentCost > -1 THEN ContentCost ELSE 0 END), 2) AS given_cost "
        "FROM exposure LEFT JOIN sales ON Occupancy = Occ GROUP BY 1",
        "exposure",
        "sales",
    ),
)
def _(spark, sf):
    side = b.lookups(spark).sales_side().withColumnRenamed("f_occ", "Occ")
    args = [F.col(c) for c in ("Occ", "Area", "AnnualSalesPerSqFt", "BusinessInvPctofSales")]
    return (
        exposure(spark, sf)
        .join(side, "Occ", "left")
        .groupBy("Occ")
        .agg(
            F.round(F.sum(fd.inventory_cost(*args)), 2).alias("default_cost"),
            F.round(F.sum(fd.inventory_cost(*args, F.col("ContentCost"))), 2).alias("given_cost"),
        )
    )


@query(
    "dmg05_exposure",
    sql(
        "SELECT flExp, BDDF_ID = '0' AS zero_id, count(*) AS n, count(Debris_Tot) AS with_debris, "
        "round(sum(BldgLossUSD), 2) AS loss FROM res_exposure GROUP BY 1, 2",
        "res_exposure",
    ),
)
def _(spark, sf):
    return (
        assessed(spark, sf)
        .groupBy("flExp", (F.col("BDDF_ID") == "0").alias("zero_id"))
        .agg(F.count("*").alias("n"), F.count("Debris_Tot").alias("with_debris"), F.round(F.sum("BldgLossUSD"), 2).alias("loss"))
    )


FLOOD = "CASE l_linenumber % 4 WHEN 0 THEN 'CAE' WHEN 1 THEN 'V' WHEN 2 THEN 'VE' ELSE 'HazardRiverine' END"


@query(
    "dmg06_curve_zone",
    "SELECT occ, flood, CASE WHEN substr(occ, 1, 3) = 'RES' AND flood = 'CAE' THEN 'coastal_a' "
    "WHEN substr(occ, 1, 3) = 'RES' AND flood IN ('V', 'VE') THEN 'coastal_v' ELSE 'riverine' END AS zone, count(*) AS n FROM "
    f"(SELECT upper(split_part({b.BLDG['occtype']}, '-', 1)) AS occ, {FLOOD} AS flood FROM lineitem) "
    "WHERE occ IS NOT NULL GROUP BY ALL",
)
def _(spark, sf):
    from tidemark.functions import text

    rows = b.project(b.table(spark, sf, "lineitem"), {"occtype": b.BLDG["occtype"], "flood": FLOOD})
    rows = rows.select(text.occ_class(F.col("occtype")).alias("occ"), "flood").where("occ IS NOT NULL")
    return rows.groupBy("occ", "flood", fd.curve_zone(F.col("occ"), F.col("flood")).alias("zone")).agg(F.count("*").alias("n"))


def keyed(spark, sf):
    return exposure(spark, sf).withColumns(
        {
            "SOID": fd.specific_occupancy(F.col("Occ"), F.col("NumStories"), F.col("FoundationType")),
            "zone": fd.curve_zone(F.col("Occ"), F.lit("CAE")),
            "d": fd.clamp_depth(fd.depth_in_structure(F.col("depth_grid"), F.col("FirstFloorHt"))),
        }
    )


for _kind in ("building", "content", "inventory"):

    @query(
        f"dmg07_curve_lookup_{_kind}",
        sql(
            f"SELECT k.zone, k.soid AS SOID, c.ddf_id, count(*) AS n FROM keyed_exposure k LEFT JOIN curves c "
            f"ON c.kind = '{_kind}' AND c.zone = k.zone AND c.soid = k.soid GROUP BY ALL",
            "keyed_exposure",
            "curves",
        ),
    )
    def _(spark, sf, kind=_kind):
        found = oc.curve_lookup(keyed(spark, sf), b.lookups(spark).curves, kind)
        return found.groupBy("zone", "SOID", "ddf_id").agg(F.count("*").alias("n"))


@query(
    "dmg08_interpolate_curve",
    sql(
        f"SELECT k.zone, k.soid AS SOID, count(c.ddf_id) AS n, round(min({b.ratio_sql('slope')}), 6) AS lo, "
        f"round(max({b.ratio_sql('slope')}), 6) AS hi, round(sum({b.ratio_sql('slope')}), 4) AS total FROM keyed_exposure k "
        "JOIN curves c ON c.kind = 'building' AND c.zone = k.zone AND c.soid = k.soid GROUP BY ALL",
        "keyed_exposure",
        "curves",
    ),
)
def _(spark, sf):
    found = oc.curve_lookup(keyed(spark, sf), b.lookups(spark).curves, "building").where("curve IS NOT NULL")
    ratio = fd.interpolate(F.col("curve"), F.col("d"))
    return found.groupBy("zone", "SOID").agg(
        F.count("ddf_id").alias("n"),
        F.round(F.min(ratio), 6).alias("lo"),
        F.round(F.max(ratio), 6).alias("hi"),
        F.round(F.sum(ratio), 4).alias("total"),
    )


LOSSES = {
    "dmg09_building_loss": ("BldgDmgPct", "BldgLossUSD"),
    "dmg10_content_loss": ("ContDmgPct", "ContentLossUSD", "ContentCostUSD"),
    "dmg11_inventory_loss": ("InvDmgPct", "InventoryLossUSD", "InventoryCostUSD"),
}
for _name, _cols in LOSSES.items():

    @query(
        _name,
        sql(f"SELECT Occ, SOID, count({_cols[0]}) AS n, {total_sql(*_cols)} FROM res_exposure GROUP BY 1, 2", "res_exposure"),
    )
    def _(spark, sf, cols=_cols):
        return assessed(spark, sf).groupBy("Occ", "SOID").agg(F.count(cols[0]).alias("n"), *total(*cols))


def chosen(spark, sf, override, qc=False):
    """The user's curve id serves all three kinds; results replace the mapped column."""
    df = exposure(spark, sf).withColumns({f"u{k}": F.col("user_curve") for k in "bki"})
    mapping = {**MAPPING, "BDDF_ID": "ub", "CDDF_ID": "uk", "IDDF_ID": "ui"}
    rows = inv.apply_field_map(df, mapping).withColumn("raster_id", F.lit("stand-in"))
    rows = rows.drop("ub", "uk", "ui")
    keep = [c for c in df.columns if c not in ("depth_grid", "ub", "uk", "ui")]
    out = od.assess(rows, keep, mapping, "CoastalV", b.lookups(spark), override, qc)
    return out.withColumnsRenamed({"ub": "BDDF_ID", "uk": "CDDF_ID", "ui": "IDDF_ID"})


_OVERRIDE_COLUMNS = ("BldgDmgPct", "ContDmgPct", "InvDmgPct", "BldgLossUSD", "InventoryLossUSD")


@query(
    "dmg12_curve_override",
    sql(
        f"SELECT Occ, BDDF_ID, CDDF_ID, IDDF_ID, count(*) AS n, {total_sql(*_OVERRIDE_COLUMNS)} FROM res_chosen GROUP BY 1, 2, 3, 4",
        "res_chosen",
    ),
)
def _(spark, sf):
    out = chosen(spark, sf, "intended")
    return out.groupBy("Occ", "BDDF_ID", "CDDF_ID", "IDDF_ID").agg(F.count("*").alias("n"), *total(*_OVERRIDE_COLUMNS))


@query(
    "dmg12_curve_override_off",
    sql(f"SELECT Occ, BDDF_ID, count(*) AS n, {total_sql('BldgDmgPct', 'BldgLossUSD')} FROM res_exposure GROUP BY 1, 2", "res_exposure"),
)
def _(spark, sf):
    mapping = {**MAPPING, "BDDF_ID": "user_curve"}
    out = assessed(spark, sf, "CoastalA", "off", mapping).withColumnRenamed("user_curve", "BDDF_ID")
    return out.groupBy("Occ", "BDDF_ID").agg(F.count("*").alias("n"), *total("BldgDmgPct", "BldgLossUSD"))


_DEBRIS = ("Debris_Fin", "Debris_Struc", "Debris_Found", "Debris_Tot")


@query(
    "dmg13_debris",
    sql(f"SELECT DebrisID, count(*) AS n, {total_sql(*_DEBRIS)} FROM res_exposure GROUP BY 1", "res_exposure"),
)
def _(spark, sf):
    return assessed(spark, sf).groupBy("DebrisID").agg(F.count("*").alias("n"), *total(*_DEBRIS))


@query(
    "dmg14_restoration_days",
    sql(
        "SELECT Occ, CAST(Restor_Days_Min AS INT) AS min_days, CAST(Restor_Days_Max AS INT) AS max_days, count(*) AS n "
        "FROM res_exposure GROUP BY 1, 2, 3",
        "res_exposure",
    ),
)
def _(spark, sf):
    keys = ["Occ", F.col("Restor_Days_Min").alias("min_days"), F.col("Restor_Days_Max").alias("max_days")]
    return assessed(spark, sf).groupBy(*keys).agg(F.count("*").alias("n"))


@query(
    "dmg15_status",
    sql("SELECT status, BDDF_ID = 'Unmatched' AS marked, count(*) AS n FROM res_exposure GROUP BY 1, 2", "res_exposure"),
)
def _(spark, sf):
    return assessed(spark, sf).groupBy("status", (F.col("BDDF_ID") == "Unmatched").alias("marked")).agg(F.count("*").alias("n"))


def engine_by_raster(spark, sf):
    return plan.damage_by_raster(b.bldg(spark, sf), b.meta(spark, sf), b.pixels(spark, sf), b.lookups(spark))


@query(
    "dmg16_many_rasters",
    sql(
        "SELECT GridName, flExp, count(*) AS n, round(sum(Depth_Grid), 2) AS depth, round(sum(BldgLossUSD), 2) AS loss "
        "FROM res_sampled GROUP BY 1, 2",
        "res_sampled",
    ),
)
def _(spark, sf):
    return (
        engine_by_raster(spark, sf)
        .groupBy("GridName", "flExp")
        .agg(F.count("*").alias("n"), F.round(F.sum("Depth_Grid"), 2).alias("depth"), F.round(F.sum("BldgLossUSD"), 2).alias("loss"))
    )


@query(
    "dmg16_scattered_rasters",
    sql(
        "SELECT GridName, flExp, count(*) AS n, round(sum(Depth_Grid), 2) AS depth, " + total_sql("BldgLossUSD") + " "
        "FROM res_far_sampled GROUP BY 1, 2",
        "res_far_sampled",
    ),
)
def _(spark, sf):
    """Forty storms in one run, too far apart for few boxes to hold them."""
    out = plan.damage_by_raster(b.far_bldg(spark, sf), b.far_meta(spark, sf), b.far_pixels(spark, sf), b.lookups(spark))
    return out.groupBy("GridName", "flExp").agg(
        F.count("*").alias("n"), F.round(F.sum("Depth_Grid"), 2).alias("depth"), *total("BldgLossUSD")
    )


def projected_run(way):
    body = "SELECT GridName, flExp, count(*) AS n, round(sum(Depth_Grid), 2) AS depth, {} FROM res_utm_sampled_{} GROUP BY 1, 2"

    @query(f"dmg16_projected_{way}_zone", sql(body.format(total_sql("BldgLossUSD"), way), f"res_utm_sampled_{way}"))
    def _(spark, sf):
        """A run over rasters in metres."""
        params = plan.RunParams.of({"utm_zone": way})
        out = plan.damage_by_raster(b.utm_bldg(spark, sf), b.utm_meta(spark, sf), b.pixels(spark, sf), b.lookups(spark), params)
        return out.groupBy("GridName", "flExp").agg(F.count("*").alias("n"), F.round(F.sum("Depth_Grid"), 2).alias("depth"), *total("BldgLossUSD"))


projected_run("point")
projected_run("raster")


@query(
    "dmg17_run_counters",
    sql(
        "SELECT *, concat('grid ', GridName, ': ', processed, ' records processed, ', errors, ' row errors, ', exposed, "
        "' with flooding, ', unmatched, ' unmatched') AS message FROM (SELECT GridName, count(*) AS processed, "
        "count(*) FILTER (WHERE status = 'row_error') AS errors, count(*) FILTER (WHERE status = 'ok') AS exposed, "
        "count(*) FILTER (WHERE status = 'unmatched') AS unmatched, "
        "count(*) FILTER (WHERE status = 'missing_required') AS missing_required FROM res_sampled GROUP BY 1)",
        "res_sampled",
    ),
)
def _(spark, sf):
    return od.run_counters(engine_by_raster(spark, sf))


@query(
    "dmg18_qc_notes",
    sql(
        "SELECT note, count(*) AS n FROM (SELECT unnest([CASE WHEN uid IS NOT NULL AND lb IS NULL THEN concat('unofficial building curve ', uid) "
        "WHEN lb <> Occ THEN concat('building curve ', uid, ' is for ', lb) END, "
        "CASE WHEN uid IS NOT NULL AND lk IS NULL THEN concat('unofficial content curve ', uid) "
        "WHEN lk <> Occ THEN concat('content curve ', uid, ' is for ', lk) END, "
        "CASE WHEN uid IS NOT NULL AND li IS NULL THEN concat('unofficial inventory curve ', uid) "
        "WHEN li <> Occ THEN concat('inventory curve ', uid, ' is for ', li) END]) AS note FROM ("
        "SELECT r.*, (SELECT occupancy FROM library l WHERE l.kind = 'building' AND l.ddf_id = uid) AS lb, "
        "(SELECT occupancy FROM library l WHERE l.kind = 'content' AND l.ddf_id = uid) AS lk, "
        "(SELECT occupancy FROM library l WHERE l.kind = 'inventory' AND l.ddf_id = uid) AS li "
        "FROM res_chosen r WHERE status <> 'not_exposed')) WHERE note IS NOT NULL GROUP BY 1",
        "res_chosen",
    ),
)
def _(spark, sf):
    notes = chosen(spark, sf, "intended", qc=True).select(F.explode("qc").alias("note"))
    return notes.groupBy("note").agg(F.count("*").alias("n"))


_RUN_SUMS = (
    "Depth_Grid", "Depth_in_Struc", "BldgDmgPct", "BldgLossUSD", "ContentCostUSD", "ContDmgPct", "ContentLossUSD",
    "InventoryCostUSD", "InvDmgPct", "InventoryLossUSD", "Debris_Fin", "Debris_Struc", "Debris_Found", "Debris_Tot",
)


@query(
    "dmg19_run_damage",
    sql(
        f"SELECT GridName, Occ, SOID, status, count(*) AS n, {total_sql(*_RUN_SUMS)}, "
        "CAST(sum(Restor_Days_Min) AS BIGINT) AS min_days, CAST(sum(Restor_Days_Max) AS BIGINT) AS max_days "
        "FROM res_sampled GROUP BY 1, 2, 3, 4",
        "res_sampled",
    ),
)
def _(spark, sf):
    # the public entry on prepared engine rows, one per raster and building
    engine = plan.clipped_inventory(b.bldg(spark, sf), b.meta(spark, sf)).withColumnRenamed("raster_id", "own_raster")
    out = od.run_damage(engine, MAPPING, "CoastalA", b.meta(spark, sf), b.pixels(spark, sf), b.lookups(spark))
    own = out.where(F.col("own_raster") == F.col("GridName"))
    return own.groupBy("GridName", "Occ", "SOID", "status").agg(
        F.count("*").alias("n"),
        *total(*_RUN_SUMS),
        F.sum("Restor_Days_Min").alias("min_days"),
        F.sum("Restor_Days_Max").alias("max_days"),
    )


@query(
    "joi02_building_pixel",
    sql(
        "SELECT raster_id, depth_grid, count(*) AS n FROM sampled GROUP BY 1, 2",
        "sampled",
    ),
)
def _(spark, sf):
    from tidemark.operators import spatial

    meta = b.meta(spark, sf)
    rows = plan.clipped_inventory(b.bldg(spark, sf), meta)
    located = spatial.grid_position(spatial.with_meta(rows, meta), "Longitude", "Latitude")
    sampled = spatial.sample_depth(located, b.pixels(spark, sf), salts=4, salt_on="FltyId")
    return sampled.groupBy("raster_id", "depth_grid").agg(F.count("*").alias("n"))


@query(
    "joi03_lookup_joins",
    sql(
        "SELECT k.Occ, count(c.ddf_id) AS curves, count(x.DebrisID) AS debris, count(y.RestFnID) AS days, count(z.Occupancy) AS sales "
        "FROM joined_exposure k LEFT JOIN curves c ON c.kind = 'building' AND c.zone = k.zone AND c.soid = k.soid "
        "LEFT JOIN debris x ON x.DebrisID = k.dkey LEFT JOIN restoration y ON y.RestFnID = k.rkey "
        "LEFT JOIN sales z ON z.Occupancy = k.Occ GROUP BY 1",
        "joined_exposure",
    ),
)
def _(spark, sf):
    rows = inv.apply_field_map(exposure(spark, sf), MAPPING)
    joined = od.with_lookups(od.with_keys(rows, "CAE"), b.lookups(spark), ())
    return joined.groupBy(F.col("f_occ").alias("Occ")).agg(
        F.count("b_id").alias("curves"),
        F.count("Finishes").alias("debris"),
        F.count("Min_Restor_Days").alias("days"),
        F.count("AnnualSalesPerSqFt").alias("sales"),
    )


@query(
    "src06_curve_table",
    sql(
        f"SELECT c.kind, c.ddf_id, round(min({b.point_sql('slope', '0')}), 4) AS at_zero, round(min({b.point_sql('slope', '24')}), 4) AS at_top, "
        "count(*) AS n FROM keyed_exposure k JOIN curves c ON c.zone = k.zone AND c.soid = k.soid GROUP BY 1, 2",
        "keyed_exposure",
        "curves",
    ),
)
def _(spark, sf):
    """Curves by the loader from one file per kind and zone."""
    curves = b.loaded_lookups(spark, scratch_dir(spark)).curves.withColumnRenamed("key", "SOID")
    joined = keyed(spark, sf).join(curves, ["zone", "SOID"])
    return joined.groupBy("kind", "ddf_id").agg(
        F.round(F.min(F.element_at("curve", 5)), 4).alias("at_zero"),
        F.round(F.min(F.element_at("curve", 29)), 4).alias("at_top"),
        F.count("*").alias("n"),
    )


@query(
    "src07_rate_tables",
    sql(
        "SELECT DebrisID AS key, 'debris' AS source, count(*) AS n, round(max(Finishes), 4) AS rate FROM joined_exposure JOIN "
        "(SELECT DebrisID, Finishes AS f FROM debris) ON DebrisID = dkey GROUP BY 1 UNION ALL "
        "SELECT RestFnID, 'restoration', count(*), round(max(CAST(lo AS DOUBLE)), 4) FROM joined_exposure JOIN "
        "(SELECT RestFnID, lo_days AS lo FROM restoration) ON RestFnID = rkey GROUP BY 1 UNION ALL "
        "SELECT Occ, 'sales', count(*), round(max(stock / Area), 4) FROM joined_exposure WHERE stock > 0 GROUP BY 1",
        "joined_exposure",
    ),
)
def _(spark, sf):
    """Debris, repair and sales rates by the loaders, met by every row."""
    rows = inv.apply_field_map(exposure(spark, sf), MAPPING)
    loaded = b.loaded_lookups(spark, scratch_dir(spark))
    joined = od.with_lookups(od.with_keys(rows, "CAE"), loaded, ())
    stock = F.col("AnnualSalesPerSqFt") * F.col("BusinessInvPctofSales") / 100
    sold = exposure(spark, sf).join(loaded.sales, F.col("Occ") == F.col("Occupancy")).where("Occ IN ('COM1', 'AGR1') AND Area > 0")
    sold = sold.groupBy(F.col("Occ").alias("key")).agg(F.lit("sales").alias("source"), F.count("*").alias("n"), F.round(F.max(stock), 4).alias("rate"))

    def rates(key, value, source):
        hit = joined.where(F.col(key).isNotNull() & F.col(value).isNotNull())
        return hit.groupBy(F.col(key).alias("key")).agg(
            F.lit(source).alias("source"), F.count("*").alias("n"), F.round(F.max(F.col(value).cast("double")), 4).alias("rate")
        )

    return rates("f_debris", "Finishes", "debris").unionByName(rates("f_restore", "Min_Restor_Days", "restoration")).unionByName(sold)


# some rows lose a required value: a blank occupancy, a missing area
_GAPS = (
    "SELECT FltyId, CASE WHEN FirstFloorHt = 2 THEN ' null ' ELSE Occ END AS Occ, CASE WHEN NumStories = 3 THEN NULL ELSE Area END AS Area "
    "FROM exposure"
)


@query(
    "flt05_required_engine_fields",
    sql(
        f"SELECT CASE WHEN Occ = ' null ' OR Area IS NULL THEN 'missing_required' ELSE 'other' END AS row_kind, "
        f"CASE WHEN Occ = ' null ' OR Area IS NULL THEN CAST(-99999 AS DOUBLE) END AS marker, count(*) AS n FROM ({_GAPS}) GROUP BY 1, 2",
        "exposure",
    ),
)
def _(spark, sf):
    df = exposure(spark, sf).withColumns(
        {
            "Occ": F.when(F.col("FirstFloorHt") == 2, F.lit(" null ")).otherwise(F.col("Occ")),
            "Area": F.when(F.col("NumStories") != 3, F.col("Area")),
        }
    )
    rows = inv.apply_field_map(df, MAPPING).withColumn("raster_id", F.lit("stand-in"))
    out = od.assess(rows, ["FltyId"], MAPPING, "CoastalA", b.lookups(spark), "off")
    missing = F.col("status") == "missing_required"
    return out.groupBy(
        F.when(missing, F.col("status")).otherwise(F.lit("other")).alias("row_kind"),
        F.when(missing, F.col("Depth_in_Struc")).alias("marker"),
    ).agg(F.count("*").alias("n"))


@query(
    "snk04_srt01_sorted_by_depth",
    sql(
        "SELECT FltyId, Depth_in_Struc, BldgLossUSD FROM (SELECT FltyId, Depth_in_Struc, round(BldgLossUSD, 6) AS BldgLossUSD "
        "FROM res_exposure ORDER BY Depth_in_Struc DESC, FltyId)",
        "res_exposure",
    ),
)
def _(spark, sf):
    out = assessed(spark, sf).select("FltyId", "Depth_in_Struc", F.round("BldgLossUSD", 6).alias("BldgLossUSD"))
    path = scratch_dir(spark)
    writers.write_sorted(out, path)
    return spark.read.option("header", True).schema("FltyId string, Depth_in_Struc double, BldgLossUSD double").csv(path)
