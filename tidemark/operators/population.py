"""People affected, impacted and in need, by zone, county and event."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed, impact

KEYS = ("event", "county_geoid")


def population_by_zone(
    df: DataFrame,
    keys: Sequence[str] = KEYS,
    persons: float = fixed.PERSONS_PER_BUILDING,
    damage_threshold: float = 0.0,
) -> DataFrame:
    """Affected and impacted people per key and zone, one column per zone.

    Affected: any water at the building. Impacted: affected and damage above the
    threshold. One pass, pre-aggregated before the shuffle.
    """
    wet = F.col("depth_grid") > 0
    hurt = wet & (F.col("bldgdmgpct") > damage_threshold)
    columns = []
    for name, test in (("affected", wet), ("impacted", hurt)):
        for z in fixed.ZONES:
            n = F.count_if(test & (F.col("zone") == z))
            columns.append((n * F.lit(persons)).alias(f"pop_{name}_{z.lower()}"))
    return df.groupBy(*keys).agg(*columns)


def mass_care_demand(df: DataFrame) -> DataFrame:
    """Add households in need of shelter and feeding by zone, and the shelter total."""
    out = df
    for name, rates in (("shelter", fixed.SHELTER_RATE), ("feeding", fixed.FEEDING_RATE)):
        for z in fixed.ZONES:
            need = impact.mass_care(F.col(f"pop_impacted_{z.lower()}"), z, rates)
            out = out.withColumn(f"hh_{name}_{z.lower()}", need)
    total = sum((F.col(f"hh_shelter_{z.lower()}") for z in fixed.ZONES[1:]), F.col("hh_shelter_low"))
    return out.withColumn("total_shelter_est", total)


def tract_severity_inputs(df: DataFrame, geo: str = "tract_geoid") -> DataFrame:
    """Per tract: share of each damage state, percent destroyed and major, deepest water."""
    share = {
        s: F.avg((F.col("damage_state") == s).cast("double"))
        for s in ("Slight", "Moderate", "Extensive", "Complete")
    }
    return df.groupBy(geo).agg(
        F.count(F.lit(1)).alias("n_buildings"),
        *[v.alias(f"frac_{k.lower()}") for k, v in share.items()],
        (share["Complete"] * 100).alias("pct_destroyed"),
        (share["Extensive"] * 100).alias("pct_major"),
        F.max("depth_grid").alias("max_intensity"),
    )


def with_severity(tracts: DataFrame) -> DataFrame:
    return tracts.withColumn("severity", impact.tract_severity(F.col("pct_destroyed")))


def habitability(tracts: DataFrame, utility: DataFrame, shelter: DataFrame, geo: str = "tract_geoid") -> DataFrame:
    """Building habitability factor per tract.

    ``utility``: ``damage_state, usability, u`` with usability FU, PU or NU;
    ``shelter``: ``severity, usability, s``. Not usable buildings weigh 1 whatever the
    severity. ``tracts`` carries the ``frac_*`` shares and ``severity``.
    """
    states = ("Slight", "Moderate", "Extensive", "Complete")
    pairs = ", ".join(f"'{s}', frac_{s.lower()}" for s in states)
    long = tracts.select(
        geo, "severity", F.expr(f"stack({len(states)}, {pairs}) AS (damage_state, frac)")
    )
    weight = F.when(F.col("usability") == "NU", F.lit(1.0)).otherwise(F.col("s"))
    return (
        long.join(utility, "damage_state")
        .join(shelter, ["severity", "usability"], "left")
        .groupBy(geo)
        .agg(F.sum(F.col("frac") * F.col("u") * weight).alias("bhi_factor"))
    )


def join_population(tracts: DataFrame, census: DataFrame, key: str = "tract_geoid") -> DataFrame:
    """Left join of tracts to census population and vulnerability rank."""
    return tracts.join(census, key, "left")


def shelter_demand(df: DataFrame) -> DataFrame:
    """Shelter seekers for the low and high habitability factor."""
    rate = impact.svi_rate(F.col("svi_rank"))
    return df.withColumn("svi_rate", rate).withColumns(
        {
            "shelter_low": impact.shelter_seekers(F.col("population"), F.col("bhi_low"), rate),
            "shelter_high": impact.shelter_seekers(F.col("population"), F.col("bhi_high"), rate),
        }
    )


def population_flow(
    counties: DataFrame,
    impact_rates: DataFrame,
    share: str = "pct_affected",
) -> DataFrame:
    """County people to affected, impacted and mass care, per zone.

    ``counties``: one row per county and zone with ``population``, the share affected
    in percent and the zone's part of it (``zone_share``). ``impact_rates``: ``zone,
    impacted_rate, shelter_rate, feeding_rate``.
    """
    affected = F.col("population") * F.col(share) / 100 * F.col("zone_share")
    return (
        counties.join(impact_rates, "zone")
        .withColumn("affected", affected)
        .withColumn("impacted", F.col("affected") * F.col("impacted_rate"))
        .withColumn("shelter", F.col("impacted") * F.col("shelter_rate"))
        .withColumn("feeding", F.col("impacted") * F.col("feeding_rate"))
    )


POPULATION_COLUMNS = {
    ("night", "under65"): "pop2amu65",
    ("night", "over65"): "pop2amo65",
    ("day", "under65"): "pop2pmu65",
    ("day", "over65"): "pop2pmo65",
}


def displaced_population(df: DataFrame, keys: Sequence[str], probability: Column) -> DataFrame:
    """People times damage probability, by time of day and age band, one row each."""
    sums = [F.sum(F.col(c) * probability).alias(c) for c in POPULATION_COLUMNS.values()]
    parts = ", ".join(f"'{t}', '{a}', {c}" for (t, a), c in POPULATION_COLUMNS.items())
    stacked = F.expr(f"stack({len(POPULATION_COLUMNS)}, {parts}) AS (time_of_day, age_band, displaced)")
    return df.groupBy(*keys).agg(*sums).select(*keys, stacked)


def flat_shelter(df: DataFrame, displaced: str = "displaced", rate: float = fixed.FLAT_SHELTER_RATE) -> DataFrame:
    return df.withColumn("shelter_flat", F.col(displaced) * F.lit(rate))


def high_need_population(df: DataFrame, disrupted: str, weight: Column) -> DataFrame:
    return df.withColumn("high_need", impact.high_need(F.col(disrupted), weight))


def runs_by_event(results: DataFrame) -> DataFrame:
    """Rows per event and advisory."""
    return results.groupBy("event", "adv").agg(F.count(F.lit(1)).alias("n_rows"))


def runs_range(results: DataFrame) -> DataFrame:
    """Per event: number of advisories, fewest and most rows in one."""
    return (
        runs_by_event(results)
        .groupBy("event")
        .agg(
            F.count(F.lit(1)).alias("advisories"),
            F.min("n_rows").alias("min_rows"),
            F.max("n_rows").alias("max_rows"),
        )
    )


def threshold_sensitivity(
    df: DataFrame,
    variants: Mapping[str, tuple[float, float, float]] = fixed.THRESHOLD_VARIANTS,
    keys: Sequence[str] = (),
    damage_delta: float = 0.0,
) -> DataFrame:
    """Buildings per zone under each set of surge thresholds, in one scan.

    Each row is classified once per variant as map-side columns; the counts come out
    of one aggregation, so rows are not multiplied by the number of variants.
    """
    t = fixed.ZONE_THRESHOLDS
    columns, order = [], []
    for name, (low, medium, high) in variants.items():
        zone = impact.intensity_zone(
            F.col("depth_grid"),
            F.col("bldgdmgpct"),
            low,
            medium,
            high,
            t["damage_low"],
            t["damage_medium"] + damage_delta,
            t["damage_high"] + damage_delta,
        )
        for z in (*fixed.ZONES, "NONE"):
            columns.append(F.count_if(zone == z).alias(f"{name}_{z}"))
            order.append((name, z))
    wide = df.groupBy(*keys).agg(*columns)
    parts = ", ".join(f"'{n}', '{z}', `{n}_{z}`" for n, z in order)
    return wide.select(*keys, F.expr(f"stack({len(order)}, {parts}) AS (variant, zone, n_buildings)"))


def ground_truth_target(df: DataFrame) -> DataFrame:
    """Validation target: the actual shelter count, else the planned one."""
    return df.withColumn("shelter_pop", F.coalesce("actual_shelter", "planned_shelter"))


def event_inventory(inventory: DataFrame, event_states: DataFrame, event: str | None = None) -> DataFrame:
    """Inventory rows in the states of an event (or of each event).

    ``event_states``: ``event, states array<string>``. The state is the partition
    column of the stored inventory, so the join prunes files at run time.
    """
    pairs = event_states if event is None else event_states.where(F.col("event") == event)
    exploded = pairs.select("event", F.explode("states").alias("state"))
    return inventory.join(exploded, "state")


# states that one event can name
MOST_STATES = 256


def in_event_states(inventory: DataFrame, event_states: DataFrame, event: str) -> DataFrame:
    """The inventory rows in the states of one event, once each.

    States may be spelled with spaces or underscores. The semi-join is on the stored partition
    column alone: Spark evaluates the few states first and opens no folder of another one. For that
    their side is broadcast; an event of more than ``MOST_STATES`` of them fails.
    """
    of_event = event_states.where(F.col("event") == event).select(F.explode("states").alias("_s")).agg(F.collect_set("_s").alias("_s"))
    checked = F.when(F.size("_s") <= MOST_STATES, F.col("_s")).otherwise(F.raise_error(F.lit("an event names too many states")))
    few = of_event.select(F.explode(checked).alias("_s"))
    spelled = F.array_distinct(F.array("_s", F.replace("_s", F.lit("_"), F.lit(" ")), F.replace("_s", F.lit(" "), F.lit("_"))))
    return inventory.join(F.broadcast(few.select(F.explode(spelled).alias("state"))), "state", "left_semi")


def population_long(zones: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The wide zone table with one row per key and zone that has anyone in it."""
    rows = [
        F.struct(F.lit(z).alias("zone"), *[F.col(f"pop_{n}_{z.lower()}").alias(f"pop_{n}") for n in ("affected", "impacted")])
        for z in fixed.ZONES
    ]
    return zones.select(*keys, F.inline(F.array(*rows))).where("pop_affected > 0 or pop_impacted > 0")
