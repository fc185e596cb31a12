"""Column functions that classify buildings and areas and turn them into demand."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import fixed


def depth_category(depth: Column, labels: Sequence[str]) -> Column:
    """Ground depth of at least 9, 6, 3 or 1 feet to one of four labels, else ``None``."""
    deepest, deep, middle, shallow = labels
    return (
        F.when(depth >= 9, F.lit(deepest))
        .when(depth >= 6, F.lit(deep))
        .when(depth >= 3, F.lit(middle))
        .when(depth >= 1, F.lit(shallow))
        .otherwise(F.lit("None"))
    )


def intensity_zone(
    depth: Column,
    damage_pct: Column,
    surge_low=fixed.ZONE_THRESHOLDS["surge_low"],
    surge_medium=fixed.ZONE_THRESHOLDS["surge_medium"],
    surge_high=fixed.ZONE_THRESHOLDS["surge_high"],
    damage_low=fixed.ZONE_THRESHOLDS["damage_low"],
    damage_medium=fixed.ZONE_THRESHOLDS["damage_medium"],
    damage_high=fixed.ZONE_THRESHOLDS["damage_high"],
) -> Column:
    """Zone by surge depth first, by damage percentage otherwise.

    Thresholds are numbers or columns, so one pass can serve many threshold sets.
    """
    return (
        F.when(depth > surge_high, F.lit("HIGH"))
        .when(depth >= surge_medium, F.lit("MEDIUM"))
        .when(depth >= surge_low, F.lit("LOW"))
        .when(damage_pct > damage_high, F.lit("HIGH"))
        .when(damage_pct > damage_medium, F.lit("MEDIUM"))
        .when(damage_pct > damage_low, F.lit("LOW"))
        .otherwise(F.lit("NONE"))
    )


def damage_state(pct: Column) -> Column:
    """Damage percentage to a state; each band is closed below and open above."""
    return (
        F.when(pct < 15, F.lit("Slight"))
        .when(pct < 40, F.lit("Moderate"))
        .when(pct < 60, F.lit("Extensive"))
        .when(pct >= 60, F.lit("Complete"))
    )


def tract_severity(destroyed_pct: Column) -> Column:
    """Severity of a tract by its share of destroyed buildings, in percent."""
    return (
        F.when(destroyed_pct >= 35, F.lit("HIGH"))
        .when(destroyed_pct >= 11, F.lit("MEDIUM"))
        .when(destroyed_pct.isNotNull(), F.lit("LOW"))
    )


def svi_rate(rank: Column) -> Column:
    """Vulnerability rank 0 to 1 to the share that seeks shelter."""
    return (
        F.when(rank < 0.4, F.lit(0.0)).when(rank < 0.8, F.lit(0.025)).when(rank <= 1.0, F.lit(0.05))
    )


def inundation_level(surge: Column, ground: Column, foundation_height: Column) -> Column:
    """Dry, yard or structure inundation against ground and first floor elevation."""
    return (
        F.when(surge > ground + foundation_height, F.lit("structure"))
        .when(surge > ground, F.lit("yard"))
        .otherwise(F.lit("none"))
    )


def mass_care(impacted: Column, zone: str, rates: Mapping[str, float]) -> Column:
    """People of one zone who need a service, rounded half to even."""
    return F.bround(impacted * F.lit(rates[zone]), 0).cast("long")


def shelter_seekers(population: Column, habitability: Column, rate: Column) -> Column:
    return population * habitability * rate


def high_need(disrupted: Column, weight: Column) -> Column:
    return disrupted * weight
