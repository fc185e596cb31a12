"""End-to-end plans: inventory and rasters to an area table or to population demand."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed, impact, text
from tidemark.operators import damage, geography, naming, population, spatial
from tidemark.operators import inventory as inv
from tidemark.operators.curves import Lookups
from tidemark.operators.extents import Survey
from tidemark.operators.joins import fenced
from tidemark.operators.tiles import TiledPixels

ENGINE_MAPPING = {
    "UserDefinedFltyId": "FltyId",
    "OCC": "Occ",
    "Cost": "Cost",
    "Area": "Area",
    "NumStories": "NumStories",
    "FoundationType": "FoundationType",
    "FirstFloorHt": "FirstFloorHt",
    "ContentCost": "ContentCost",
    "Latitude": "Latitude",
    "Longitude": "Longitude",
}


SEPARATOR = "\n"


@dataclass
class RunParams:
    """Settings of a run. ``overrides`` of :meth:`of` replace the defaults by name."""

    flood_class: str = "CoastalA"
    categories: Sequence[str] = ("Destroyed", "Major", "Minor", "Affected")
    building_types: Mapping[str, str] = field(
        default_factory=lambda: dict.fromkeys(fixed.RESIDENTIAL_TYPES, "Y")
    )
    geography: str = "county"
    policy: str = "strict"
    null_geoid: str = "null"
    backward_fill: str = "county"
    override: str = "intended"
    utm_zone: str = "point"
    salts: int = 1
    # states to read; none means all. Stored partitions of other states are not read.
    states: Sequence[str] = ()
    # event of the event table given to the run: its states and its rasters only
    event: str | None = None

    @classmethod
    def of(cls, overrides: Mapping | None = None) -> RunParams:
        params = cls()
        for name, value in (overrides or {}).items():
            old = getattr(params, name)
            merged = {**old, **value} if isinstance(old, Mapping) and isinstance(value, Mapping) else value
            setattr(params, name, merged)
        return params


def clipped_inventory(
    inventory: DataFrame, raster_meta: DataFrame, policy: str = "strict", states: Sequence[str] = (), known: Survey | None = None
) -> DataFrame:
    """Engine rows per raster: clip to every extent, complete, de-duplicate, project.

    The best row per building is chosen inside each raster extent, as a separate run
    per raster would do. Rows outside all extents leave before the first shuffle.

    Rows of one building under the same set of rasters compete first, while they are
    still one row each; a hot building id is down to one row per task and raster set
    before it is shuffled. Then rows meet by building id, are listed per raster and
    compete again. That second exchange is on the id alone, so later steps per
    building and raster, or per building, find their rows in place. ``known``: the survey of the
    extents, where the caller has it.
    """
    used = [*fixed.STRICT_REQUIRED_COLUMNS, "val_cont", "cbfips", "state"]
    bounds = spatial.raster_bounds(raster_meta).select("raster_id", *spatial.BOUNDS)
    if states:
        inventory = inventory.where(F.col("state").isin(list(states)))
    # plain ranges on the stored columns, below the cell join, so that row groups are skipped
    known = known or spatial.surveyed(inventory, bounds)
    rows = inventory.select(*[c for c in used if c in inventory.columns])
    # a column that no filter reads
    rows = next((fenced(rows, c) for c in rows.columns if c not in fixed.STRICT_REQUIRED_COLUMNS and c != "state"), rows)
    rows = spatial.near_rasters(rows, bounds, known=known) if known else rows
    if policy == "strict":
        rows = inv.require_fields(rows)
    else:
        rows = rows.where(F.col("bid").isNotNull() & F.col("latitude").isNotNull())
    # the set travels as one text: it sorts and hashes faster than an array
    over = spatial.rasters_over(rows, bounds, prune=False, known=known).withColumn("raster_ids", F.array_join("raster_ids", SEPARATOR))
    first = inv.dedup_inventory(over, ["bid", "raster_ids"]).repartition("bid")
    pairs = first.withColumn("raster_id", F.explode(F.split("raster_ids", SEPARATOR))).drop("raster_ids")
    best = inv.dedup_inventory(pairs, ["bid", "raster_id"])
    if policy == "fill":
        best = best.fillna(fixed.FILL_DEFAULTS)
    extra = ["raster_id", *[c for c in ("cbfips", "state") if c in best.columns]]
    return inv.engine_columns(best, extra)


def of_event(inventory: DataFrame, raster_meta: DataFrame, events: DataFrame | None, event: str) -> tuple[DataFrame, DataFrame]:
    """Inventory and rasters of one event. ``events``: ``event, states array<string>, raster_pattern``."""
    if events is None:
        raise ValueError("a run of one event needs the event table")
    named = naming.rasters_of_events(events.where(F.col("event") == event), raster_meta)
    return population.in_event_states(inventory, events, event), named.select(*raster_meta.columns)


def damage_by_raster(
    inventory: DataFrame,
    raster_meta: DataFrame,
    raster_pixels: DataFrame | TiledPixels,
    lookups: Lookups,
    params: RunParams | None = None,
    events: DataFrame | None = None,
) -> DataFrame:
    """Stored inventory to per-building, per-raster results with event and advisory.

    With ``event`` among the parameters, ``events`` names its states and rasters; the scan leaves out
    the stored partitions of other states.
    """
    p = params or RunParams()
    if p.event is not None:
        inventory, raster_meta = of_event(inventory, raster_meta, events, p.event)
    known = spatial.surveyed(inventory, spatial.raster_bounds(raster_meta))
    engine = clipped_inventory(inventory, raster_meta, p.policy, p.states, known)
    rows = fenced(inv.apply_field_map(engine, ENGINE_MAPPING), "f_cost")
    # event and advisory come from the raster's name, once per raster
    named = raster_meta.withColumns(
        {"event": text.raster_event(F.col("raster_id")), "adv": text.raster_advisory(F.col("raster_id"))}
    )
    placed = spatial.with_meta(rows, named, known)
    located = spatial.grid_position(placed, "f_lon", "f_lat", p.utm_zone)
    sampled = spatial.sample_depth(located, raster_pixels, p.salts, "f_id", raster_meta, known)
    keep = [c for c in engine.columns if c != "raster_id"] + ["event", "adv"]
    return damage.assess(sampled, keep, ENGINE_MAPPING, p.flood_class, lookups, p.override)


def run_impact(
    inventory: DataFrame,
    raster_meta: DataFrame,
    raster_pixels: DataFrame | TiledPixels,
    lookups: Lookups,
    svi: DataFrame,
    params: RunParams | None = None,
    events: DataFrame | None = None,
) -> DataFrame:
    """Inventory and rasters to the final area table, in one plan.

    The census block travels with the building row, so results need no join back to
    the inventory.
    """
    p = params or RunParams()
    results = inv.lowercase_columns(damage_by_raster(inventory, raster_meta, raster_pixels, lookups, p, events))
    best = geography.dedup_predictions(results.select("fltyid", "occ", "cbfips", "depth_grid", "bldgdmgpct"))
    homes = inv.residential_filter(best.withColumn("cbfips", text.block_fips(F.col("cbfips"))), p.building_types)
    placed = geography.classify(geography.with_geoids(homes, p.null_geoid), p.categories)
    areas = geography.join_svi(geography.damage_counts(placed, p.categories, p.geography), svi)
    return geography.final_output(geography.fill_names(areas, backward=p.backward_fill), p.categories)


def run_population(results: DataFrame, building_types: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Results of many events to people affected, impacted and in need per county."""
    low = inv.lowercase_columns(results)
    homes = inv.residential_filter(low, building_types)
    zoned = geography.with_geoids(homes.withColumn("cbfips", text.block_fips(F.col("cbfips")))).withColumn(
        "zone", impact.intensity_zone(F.col("depth_grid"), F.col("bldgdmgpct"))
    )
    return population.mass_care_demand(population.population_by_zone(zoned))
