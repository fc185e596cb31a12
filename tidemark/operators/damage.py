"""The damage run: building rows and rasters in, losses out, in one plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import damage as d
from tidemark.functions import fixed, text
from tidemark.operators import inventory as inv
from tidemark.operators import spatial
from tidemark.operators.curves import KINDS, Lookups
from tidemark.operators.joins import fenced
from tidemark.operators.tiles import TiledPixels


USER_CURVE = {"b": "f_bddf", "k": "f_cddf", "i": "f_iddf"}


def with_keys(df: DataFrame, flood_class: str | Column) -> DataFrame:
    """Add depth in structure, lookup keys and zone to rows with ``f_*`` and ``depth_grid``."""
    zone = F.lit(flood_class) if isinstance(flood_class, str) else flood_class
    occ, foundation = F.col("f_occ"), F.col("f_foundation")
    deep = df.withColumn("f_depth", d.depth_in_structure(F.col("depth_grid"), F.col("f_height")))
    clamped = deep.withColumn("f_d", d.clamp_depth(F.col("f_depth")))
    low, fraction = d.curve_position(F.col("f_d"))
    curve_keys = clamped.withColumns(
        {
            "f_key": d.specific_occupancy(occ, F.col("f_stories"), foundation),
            "f_zone": d.curve_zone(occ, zone),
            "f_wet": d.is_exposed(F.col("depth_grid")),
        }
    )
    return curve_keys.withColumns(
        {
            "f_low": low,
            "f_frac": fraction,
            "f_debris": d.debris_key(occ, foundation, F.col("f_d")),
            "f_restore": d.restoration_key(occ, F.col("f_d")),
        }
    )


def with_lookups(df: DataFrame, lookups: Lookups, user_kinds: Sequence[str] = tuple(KINDS)) -> DataFrame:
    """Join curves, user curves, debris, restoration and sales by equality, all left.

    ``user_kinds`` are the kinds for which curve ids of the user count.
    """
    curves = lookups.default_side().withColumnsRenamed({"zone": "f_zone", "SOID": "f_key", "low": "f_low"})
    out = df.join(curves, ["f_zone", "f_key", "f_low"], "left")
    none = {}
    for kind, p in KINDS.items():
        if kind in user_kinds and lookups.library is not None:
            side = lookups.library_side(kind)
            same = (F.col(USER_CURVE[p]) == F.col(f"u{p}_key")) & (F.col("f_low") == F.col("low"))
            out = out.join(side, same, "left").drop("low")
        else:
            none |= {f"u{p}_{c}": F.lit(None).cast("string") for c in ("key", "occ")}
            none |= {f"u{p}_{c}": F.lit(None).cast("double") for c in ("lo", "hi")}
    return (
        out.withColumns(none)
        .join(lookups.debris_side().withColumnRenamed("DebrisID", "f_debris"), "f_debris", "left")
        .join(lookups.restoration_side().withColumnRenamed("RestFnID", "f_restore"), "f_restore", "left")
        .join(lookups.sales_side(), "f_occ", "left")
    )


def with_losses(df: DataFrame, content_mapped: bool, inventory_mapped: bool) -> DataFrame:
    """Add one column per result, before the row status is applied.

    The user's curve comes first where the library has it. Outside the stocked
    occupancies no inventory curve applies: id 0, damage 0.
    """
    occ, cost, area = F.col("f_occ"), F.col("f_cost"), F.col("f_area")
    stocked = d.has_inventory(occ)
    ids, ratio = {}, {}
    for p in KINDS.values():
        theirs = F.col(f"u{p}_key").isNotNull()
        lo, hi = (F.when(theirs, F.col(f"u{p}_{e}")).otherwise(F.col(f"{p}_{e}")) for e in ("lo", "hi"))
        ids[p] = F.coalesce(F.col(f"u{p}_key"), F.col(f"{p}_id"))
        ratio[p] = d.between_points(lo, hi, F.col("f_frac"))
    no_stock = ~stocked & F.col("ui_key").isNull()
    content = d.content_cost(occ, cost, F.col("f_content") if content_mapped else None)
    stock = d.inventory_cost(
        occ,
        area,
        F.col("AnnualSalesPerSqFt"),
        F.col("BusinessInvPctofSales"),
        F.col("f_invcost") if inventory_mapped else None,
    )
    return df.withColumns(
        {
            "o_b_id": ids["b"],
            "o_k_id": ids["k"],
            "o_i_id": F.when(no_stock, F.lit("0")).otherwise(ids["i"]),
            "o_b": ratio["b"],
            "o_k": ratio["k"],
            "o_i": F.when(no_stock, F.lit(0.0)).otherwise(ratio["i"]),
            "o_content_cost": content,
            "o_stock_cost": stock,
            "o_fin": d.debris_tons(area, F.col("Finishes")),
            "o_struc": d.debris_tons(area, F.col("Structure")),
            "o_found": d.debris_tons(area, F.col("Foundation")),
        }
    )


def row_status() -> Column:
    """``missing_required``, ``row_error``, ``not_exposed``, ``unmatched`` or ``ok``."""
    unreadable = F.lit(False)
    for c in ("f_cost", "f_area", "f_stories", "f_foundation", "f_height", "f_lat", "f_lon"):
        unreadable = unreadable | F.col(c).isNull()
    no_rates = F.col("f_debris").isNotNull() & F.col("o_fin").isNull()
    no_days = F.col("f_restore").isNotNull() & F.col("Min_Restor_Days").isNull()
    incomplete = F.col("o_k").isNull() | F.col("o_i").isNull() | no_rates | no_days
    return (
        F.when(F.col("f_missing"), F.lit("missing_required"))
        .when(unreadable, F.lit("row_error"))
        .when(~F.col("f_wet"), F.lit("not_exposed"))
        .when(F.col("o_b").isNull(), F.lit("unmatched"))
        .when(incomplete, F.lit("row_error"))
        .otherwise(F.lit("ok"))
    )


def qc_notes() -> Column:
    """Notes on user curve ids: unknown id, or a curve made for another occupancy."""
    notes = []
    for kind, p, user in (("building", "b", "f_bddf"), ("content", "k", "f_cddf"), ("inventory", "i", "f_iddf")):
        given = F.col(user).isNotNull() & (F.col(user) != "0")
        known = F.col(f"u{p}_key").isNotNull()
        notes.append(
            F.when(given & ~known, F.concat(F.lit(f"unofficial {kind} curve "), F.col(user))).when(
                given & known & ~(F.col(f"u{p}_occ") == F.col("f_occ")),
                F.concat(F.lit(f"{kind} curve "), F.col(user), F.lit(" is for "), F.col(f"u{p}_occ")),
            )
        )
    exposed = F.col("status").isin("ok", "unmatched", "row_error")
    return F.when(exposed, F.array_compact(F.array(*notes))).otherwise(F.array().cast("array<string>"))


def with_gates(df: DataFrame) -> DataFrame:
    """Add what the row status lets through, as a few columns that results share.

    The split into small projections keeps each generated method short enough for the
    JVM to compile; one projection with everything runs interpreted, many times slower.
    """
    status = F.col("status")
    hit = status.isin("ok", "row_error") & F.col("f_wet") & F.col("o_b").isNotNull()
    flagged = df.withColumns(
        {
            "g_dry": status == "not_exposed",
            "g_hit": F.coalesce(hit, F.lit(False)),
            "g_known": status != "missing_required",
        }
    )
    dry, hit, known = F.col("g_dry"), F.col("g_hit"), F.col("g_known")
    ratios = {f"g_{p}": F.when(dry, F.lit(0.0)).when(hit, F.col(f"o_{p}")) for p in KINDS.values()}
    ids = {f"g_{p}_id": F.when(dry, F.lit("0")).when(hit, F.col(f"o_{p}_id")) for p in KINDS.values()}
    gated = flagged.withColumns({**ratios, **ids, "g_under": hit & (F.col("f_d") > 0)})
    under = F.col("g_under")
    return gated.withColumns(
        {
            "g_content": F.when(known, F.col("o_content_cost")),
            "g_stock": F.when(known, F.col("o_stock_cost")),
            "g_cost": d.truncated(F.col("f_cost")),
            "g_fin": F.when(under, F.col("o_fin")),
            "g_struc": F.when(under, F.col("o_struc")),
            "g_found": F.when(under, F.col("o_found")),
            "g_min": F.when(under, F.col("Min_Restor_Days")).when(dry | hit, F.lit(0)),
            "g_max": F.when(under, F.col("Max_Restor_Days")).when(dry | hit, F.lit(0)),
        }
    )


def result_columns() -> list[tuple[str, Column]]:
    """The output columns by name, blank where the row status leaves them blank."""
    known = F.col("g_known")
    return [
        ("Depth_Grid", F.when(known, F.col("depth_grid"))),
        ("Depth_in_Struc", F.when(known, F.col("f_depth")).otherwise(F.lit(fixed.MISSING_ROW_DEPTH))),
        ("flExp", F.when(known, F.col("f_wet").cast("int"))),
        ("SOID", F.when(known, F.col("f_key"))),
        ("BDDF_ID", F.when(F.col("status") == "unmatched", F.lit("Unmatched")).otherwise(F.col("g_b_id"))),
        ("BldgDmgPct", F.col("g_b") * 100),
        ("BldgLossUSD", F.col("g_b") * F.col("g_cost")),
        ("ContentCostUSD", F.col("g_content")),
        ("CDDF_ID", F.col("g_k_id")),
        ("ContDmgPct", F.col("g_k") * 100),
        ("ContentLossUSD", F.col("g_k") * F.col("g_content")),
        ("InventoryCostUSD", F.col("g_stock")),
        ("IDDF_ID", F.col("g_i_id")),
        ("InvDmgPct", F.col("g_i") * 100),
        ("InventoryLossUSD", F.col("g_i") * F.col("g_stock")),
        ("DebrisID", F.when(F.col("g_dry"), F.lit("")).when(F.col("g_under"), F.col("f_debris"))),
        ("Debris_Fin", F.col("g_fin")),
        ("Debris_Struc", F.col("g_struc")),
        ("Debris_Found", F.col("g_found")),
        ("Debris_Tot", F.col("g_fin") + F.col("g_struc") + F.col("g_found")),
        ("Restor_Days_Min", F.col("g_min").cast("int")),
        ("Restor_Days_Max", F.col("g_max").cast("int")),
        ("GridName", F.col("raster_id")),
    ]


def assess(
    sampled: DataFrame,
    keep: Sequence[str],
    mapping: Mapping[str, str] | Sequence[str],
    flood_class: str,
    lookups: Lookups,
    override: str = "intended",
    qc: bool = False,
) -> DataFrame:
    """Damage of rows that already carry ``f_*`` columns, ``raster_id`` and ``depth_grid``.

    Stateless, so it serves batch and streaming frames alike.
    """
    names = inv.normalize_field_map(mapping)
    code = flood_code(flood_class)
    if override not in ("intended", "off"):
        raise ValueError("override must be 'intended' or 'off'")
    mapped = {"building": "BDDF_ID", "content": "CDDF_ID", "inventory": "IDDF_ID"}
    user_kinds = [k for k, field in mapped.items() if names[field] and override == "intended"]
    rows = with_lookups(fenced(with_keys(sampled, code), "f_frac"), lookups, user_kinds)
    rows = with_losses(fenced(rows, "f_cost"), bool(names["ContentCost"]), bool(names["InvCost"]))
    rows = with_gates(rows.withColumn("status", row_status()))
    rename = {k: names[k] for k in ("SOID", "BDDF_ID", "CDDF_ID", "IDDF_ID") if names[k]}
    results = [(rename.get(name, name), col) for name, col in result_columns()]
    replaced = {name for name, _ in results}
    kept = [F.col(f"`{c}`") for c in keep if c not in replaced]
    extra = [qc_notes().alias("qc")] if qc else []
    return rows.select(
        *kept, *[col.alias(name) for name, col in results], F.lit(flood_class).alias("flc"), "status", *extra
    )


def flood_code(flood_class: str) -> str:
    """Flood class spelling to its code, on the driver."""
    s = "" if flood_class is None else str(flood_class).strip()
    return fixed.FLOOD_CLASS_SPELLINGS.get(s.lower(), s)


def raster_list(names: str | Sequence[str]) -> list[str]:
    """Raster names split on commas, trimmed, blanks dropped; empty is an error."""
    given = [names] if isinstance(names, str) else [n for n in (names or []) if n is not None]
    out = [part.strip() for n in given for part in str(n).split(",") if part.strip()]
    if not out:
        raise ValueError("at least one raster must be provided")
    return out


def raster_list_rows(df: DataFrame, column: str) -> DataFrame:
    """The same for a column of comma-separated lists: one row per name."""
    name = text.strip(F.col("_part"))
    return (
        df.withColumn("_part", F.explode(F.split(F.col(column), ",")))
        .withColumn("raster", name)
        .where(F.col("raster") != "")
        .drop("_part")
    )


def run_damage(
    inventory: DataFrame,
    mapping: Mapping[str, str] | Sequence[str],
    flood_class: str,
    raster_meta: DataFrame,
    raster_pixels: DataFrame | TiledPixels,
    lookups: Lookups,
    rasters: str | Sequence[str] | None = None,
    clip: bool = True,
    override: str = "intended",
    utm_zone: str = "point",
    salts: int = 1,
    qc: bool = False,
) -> DataFrame:
    """Losses of every building under every raster whose extent holds it.

    One plan serves all rasters. ``rasters`` restricts the run to named ones;
    ``clip=False`` also returns the dry rows outside each named raster's extent.
    Rows whose place is missing or unreadable are in no extent; they come once per raster,
    as ``missing_required`` or ``row_error``. Numeric coordinates narrow the scan to the
    extents; coordinates stored as text are read whole.
    The input columns are kept; ``flc`` and ``status`` are added to the results.
    """
    if rasters is not None:
        names = raster_list(rasters)
        raster_meta = raster_meta.where(F.col("raster_id").isin(names))
        named = lambda raster_id: raster_id.isin(names)
        raster_pixels = raster_pixels.where_raster(named) if isinstance(raster_pixels, TiledPixels) else raster_pixels.where(named(F.col("raster_id")))
    elif not clip:
        raise ValueError("clip=False needs the raster names")
    names_of = inv.normalize_field_map(mapping)
    lon, lat = names_of["Longitude"], names_of["Latitude"]
    known = None
    if clip and lon in inventory.columns and lat in inventory.columns:
        bounds = spatial.raster_bounds(raster_meta)
        known = spatial.surveyed(inventory, bounds, f"`{lon}`", f"`{lat}`")
        inventory = spatial.near_rasters(inventory, bounds, f"`{lon}`", f"`{lat}`", known=known) if known else inventory
    rows = fenced(inv.apply_field_map(inventory, mapping), "f_cost")
    if clip:
        # what has no readable place cannot be clipped: such rows are reported once per raster
        blank = F.col("f_missing") & ((F.col("f_lat") == 0) | (F.col("f_lon") == 0))
        placed = spatial.bbox_join(rows, spatial.raster_bounds(raster_meta), "f_lon", "f_lat", nowhere=blank, known=known)
        placed = placed.withColumns({"f_lat": spatial.on_earth("f_lat", 90), "f_lon": spatial.on_earth("f_lon", 360)})
    else:
        placed = spatial.every_raster(rows, raster_meta, names)
    located = spatial.grid_position(placed, "f_lon", "f_lat", utm_zone)
    sampled = spatial.sample_depth(located, raster_pixels, salts, "f_id", raster_meta, known)
    return assess(sampled, inventory.columns, mapping, flood_class, lookups, override, qc)


def run_counters(results: DataFrame) -> DataFrame:
    """Per grid: rows processed, row errors, exposed rows, unmatched rows, message."""
    counts = results.groupBy("GridName").agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(F.col("status") == "row_error").alias("errors"),
        F.count_if(F.col("status") == "ok").alias("exposed"),
        F.count_if(F.col("status") == "unmatched").alias("unmatched"),
        F.count_if(F.col("status") == "missing_required").alias("missing_required"),
    )
    message = F.format_string(
        "grid %s: %d records processed, %d row errors, %d with flooding, %d unmatched",
        "GridName",
        "processed",
        "errors",
        "exposed",
        "unmatched",
    )
    return counts.withColumn("message", message)


def refuse_row_errors(counters: DataFrame, most: int = 0) -> None:
    """Raises where a grid of :func:`run_counters` has more than ``most`` row errors."""
    bad = counters.where(F.col("errors") > most).orderBy(F.desc("errors"), "GridName").first()
    if bad is not None:
        raise ValueError(f"row errors in the run: {bad['message']}")


def sort_by_depth(results: DataFrame, tie: str = "FltyId") -> DataFrame:
    """Deepest first. The id breaks ties, which also spreads one repeated depth
    over several range partitions."""
    return results.orderBy(F.col("Depth_in_Struc").desc_nulls_last(), F.col(tie))
