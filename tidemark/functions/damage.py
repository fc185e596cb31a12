"""Column functions of the building damage model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import fixed


def depth_in_structure(depth_grid: Column, first_floor_height: Column) -> Column:
    """Water depth above the first floor. Negative values are kept."""
    return depth_grid - first_floor_height


def is_exposed(depth_grid: Column) -> Column:
    """A building is exposed when the sampled ground depth is above zero."""
    return F.coalesce(depth_grid, F.lit(0.0)) > 0


def specific_occupancy(occ: Column, stories: Column, foundation: Column) -> Column:
    """Curve key: occupancy prefix, story class, basement suffix."""
    n = F.length(occ)
    tail = (
        F.when(n > 3, F.substring(occ, 4, 1000))
        .when(n == 3, occ)
        .when(n == 2, F.substring(occ, 2, 1))
        .otherwise(F.lit(""))
    )
    prefix = F.when(occ == "REL1", F.lit("RE1")).otherwise(F.concat(F.substring(occ, 1, 1), tail))
    family = F.substring(occ, 1, 4)
    capped = F.when(stories > 3, F.lit(3.0)).otherwise(stories)
    whole = F.bround(capped, 0)
    middle = (
        F.when(
            family == "RES3",
            F.when(stories > 4, F.lit("5")).when(stories > 2, F.lit("3")).otherwise(F.lit("1")),
        )
        .when(
            family == "RES1",
            F.when(capped == whole, whole.cast("int").cast("string")).otherwise(F.lit("S")),
        )
        .when(family == "RES2", F.lit("1"))
        .otherwise(F.when(stories > 6, F.lit("H")).when(stories > 3, F.lit("M")).otherwise(F.lit("L")))
    )
    suffix = F.when(foundation == fixed.BASEMENT_CODE, F.lit("B")).otherwise(F.lit("N"))
    return F.concat(prefix, middle, suffix)


def truncated(c: Column) -> Column:
    """Drop the fraction, toward zero. NULL where the value is no number of that size."""
    return c.try_cast("long").cast("double")


def content_multiplier(occ: Column) -> Column:
    return (
        F.when(occ.isin(fixed.CONTENT_HALF), F.lit(0.5))
        .when(occ.isin(fixed.CONTENT_FULL), F.lit(1.0))
        .when(occ.isin(fixed.CONTENT_ONE_AND_HALF), F.lit(1.5))
        .otherwise(F.lit(0.0))
    )


def content_cost(occ: Column, cost: Column, given: Column | None = None) -> Column:
    """Given content value, or the occupancy multiple of the building cost.

    The default applies when no content column is mapped (``given=None``) or when
    the given value truncates to -1; a mapped blank arrives here as 0 and stays 0.
    """
    default = truncated(cost) * content_multiplier(occ)
    if given is None:
        return default
    value = truncated(given)
    return F.when(value == -1, default).otherwise(value)


def has_inventory(occ: Column) -> Column:
    return occ.isin(fixed.INVENTORY_OCCUPANCIES)


def inventory_cost(
    occ: Column,
    area: Column,
    sales_per_sqft: Column,
    inventory_pct: Column,
    given: Column | None = None,
) -> Column:
    """Business inventory value from sales per area, unless a value is given."""
    default = F.coalesce(sales_per_sqft * inventory_pct * area / 100, F.lit(0.0))
    if given is None:
        return F.when(has_inventory(occ), default).otherwise(F.lit(0.0))
    return (
        F.when(has_inventory(occ) & (given == -1), default)
        .when(given > -1, given)
        .otherwise(F.lit(0.0))
    )


def curve_zone(occ: Column, flood_class: Column) -> Column:
    """Which default curve set applies: coastal A, coastal V or riverine."""
    residential = F.substring(occ, 1, 3) == "RES"
    return (
        F.when(residential & (flood_class == "CAE"), F.lit("coastal_a"))
        .when(residential & flood_class.isin("V", "VE"), F.lit("coastal_v"))
        .otherwise(F.lit("riverine"))
    )


def clamp_depth(depth: Column) -> Column:
    """Limit the depth to the range curves are defined on."""
    low, high = F.lit(float(fixed.MIN_CURVE_DEPTH)), F.lit(float(fixed.MAX_CURVE_DEPTH))
    return F.when(depth > high, high).when(depth < low, low).otherwise(depth)


def curve_position(depth: Column) -> tuple[Column, Column]:
    """Curve point at or below a clamped depth, and the fraction to the next one."""
    low = F.floor(depth)
    return (low - F.lit(fixed.MIN_CURVE_DEPTH)).cast("int"), depth - low


def between_points(low_value: Column, high_value: Column, fraction: Column) -> Column:
    """Damage ratio between two neighbouring points given in percent."""
    return (low_value + fraction * (high_value - low_value)) / 100


def interpolate(curve: Column, depth: Column) -> Column:
    """Damage ratio at a depth, linear between the two neighbouring whole feet.

    ``curve`` holds percentages from the lowest to the highest curve depth.
    """
    low, fraction = curve_position(clamp_depth(depth))
    base = F.get(curve, low)
    return between_points(base, F.coalesce(F.get(curve, low + 1), base), fraction)


def debris_key(occ: Column, foundation: Column, depth: Column) -> Column:
    """Debris table key. ``depth`` is the clamped depth in the structure, above zero."""
    basement = foundation == fixed.BASEMENT_CODE
    footing = F.when(basement | (foundation == fixed.SLAB_CODE), F.lit("SG")).otherwise(F.lit("FT"))
    deep_set = occ.isin("RES1", "COM6") & basement
    with_basement = F.when((occ == "RES1") & basement, F.lit("B")).otherwise(F.lit("NB"))
    basement_step = (
        F.when(depth < 4, F.lit("0")).when(depth < 6, F.lit("4")).when(depth < 8, F.lit("6")).otherwise(F.lit("8"))
    )
    common_step = (
        F.when(depth < 1, F.lit("0"))
        .when(depth < 4, F.lit("1"))
        .when(depth < 8, F.lit("4"))
        .when(depth < 12, F.lit("8"))
        .otherwise(F.lit("12"))
    )
    step = F.when(deep_set, basement_step).otherwise(common_step)
    return F.when(depth > 0, F.concat(occ, with_basement, footing, step))


def restoration_key(occ: Column, depth: Column) -> Column:
    """Restoration table key. ``depth`` is the clamped depth in the structure."""
    step = (
        F.when(depth < 1, F.lit("1"))
        .when(depth < 4, F.lit("4"))
        .when(depth < 8, F.lit("8"))
        .when(depth < 12, F.lit("12"))
        .otherwise(F.lit("24"))
    )
    return F.when(depth > 0, F.concat(occ, step))


def debris_tons(area: Column, rate: Column) -> Column:
    """Rates are tons per 1000 square feet."""
    return area * rate / 1000
