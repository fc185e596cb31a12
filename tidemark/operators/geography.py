"""From per-building results to tract and county tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import fixed, impact, text
from tidemark.operators import inventory as inv


def dedup_predictions(results: DataFrame, keys: Sequence[str] = ("fltyid",)) -> DataFrame:
    """Per building keep the row with the highest building damage percentage.

    Ties go to the deeper water, then to the smallest remaining values.
    """
    rest = [c for c in ("occ", "cbfips", "gridname", "cost", "area", "latitude", "longitude", "numstories") if c in results.columns and c not in keys]
    order = [F.col("bldgdmgpct").desc_nulls_last(), F.col("depth_grid").desc_nulls_last()]
    return inv.keep_first(results, keys, order + [F.col(c).asc_nulls_first() for c in rest])


def attach_blocks(results: DataFrame, blocks: DataFrame) -> DataFrame:
    """Left join of results to their census block by building id."""
    return results.join(blocks, "fltyid", "left")


def matched_rate(df: DataFrame, column: str) -> DataFrame:
    """Rows, rows with a value in ``column`` and the share in percent (one decimal)."""
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col(column).isNotNull()).alias("matched")
    ).withColumn("matched_pct", F.round(F.col("matched") * 100.0 / F.greatest(F.col("total"), F.lit(1)), 1))


def with_geoids(df: DataFrame, null_geoid: str = "null") -> DataFrame:
    """Add tract, county and state codes from ``cbfips``."""
    block = text.zero_fill(F.col("cbfips"), 15)
    out = df
    for level in ("tract", "county", "state"):
        out = out.withColumn(f"{level}_geoid", text.geoid(block, level, null_geoid))
    return out


def geography_column(geography: str) -> str:
    """Column that a geography setting groups by."""
    try:
        return {"census tract": "tract_geoid", "county": "county_geoid"}[geography]
    except KeyError:
        raise ValueError("geography must be 'census tract' or 'county'") from None


def count_column(label: str) -> str:
    return f"Total_Num_Building_{label}"


def damage_counts(df: DataFrame, labels: Sequence[str], geography: str = "county") -> DataFrame:
    """Per area: buildings in total and per category, ordered by nothing (see SRT-2)."""
    geo = geography_column(geography)
    per_label = [F.count_if(F.col("damage_category") == s).alias(count_column(s)) for s in labels]
    return (
        df.groupBy(F.col(geo).alias("FIPS"))
        .agg(F.count("fltyid").alias("Total_Num_Building"), *per_label)
        .select(
            F.substring("FIPS", 1, 2).alias("State_FIPS"),
            F.substring("FIPS", 1, 5).alias("County_FIPS"),
            "FIPS",
            "Total_Num_Building",
            *[count_column(s) for s in labels],
        )
    )


def by_fips(df: DataFrame) -> DataFrame:
    return df.orderBy("FIPS")


def category_distribution(df: DataFrame, column: str = "damage_category") -> DataFrame:
    """Rows per category with their share of all rows in percent."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(column, "n", F.round(F.col("n") * 100.0 / total, 1).alias("pct"))


def distinct_geographies(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Number of distinct counties and tracts."""
    count = F.approx_count_distinct if approximate else F.countDistinct
    # tracts nest in counties: remove repeats once, then count the few left
    pairs = df.select("county_geoid", "tract_geoid")
    return (pairs if approximate else pairs.distinct()).agg(count("county_geoid").alias("counties"), count("tract_geoid").alias("tracts"))


# relative standard error of a sketch of 2^k buckets
SKETCH_BITS = 14


def sketch_error(bits: int = SKETCH_BITS) -> float:
    """Relative standard error of a distinct count from sketches of ``2 ** bits`` buckets."""
    return 1.04 / 2 ** (bits / 2)


def geography_sketches(df: DataFrame, keys: Sequence[str], columns: Sequence[str] = ("county_geoid", "tract_geoid", "fltyid"), bits: int = SKETCH_BITS) -> DataFrame:
    """Mergeable sketches of the distinct values of ``columns`` for each of ``keys``, to be stored.

    A sketch has a fixed size, so runs of new events add theirs without reading old results again.
    """
    return df.groupBy(*keys).agg(*[F.hll_sketch_agg(c, bits).alias(c) for c in columns])


def count_sketches(sketches: DataFrame, keys: Sequence[str] = (), columns: Sequence[str] = ("county_geoid", "tract_geoid", "fltyid")) -> DataFrame:
    """Distinct values over stored sketches, merged by ``keys`` (all into one row without any)."""
    return sketches.groupBy(*keys).agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(f"n_{c}") for c in columns])


def join_svi(areas: DataFrame, svi: DataFrame) -> DataFrame:
    return areas.join(svi, "FIPS", "left")


def _first_value(name: str) -> Column:
    return F.min_by(F.col(name), F.when(F.col(name).isNotNull(), F.col("FIPS")))


def fill_names(
    areas: DataFrame, names: Sequence[str] = ("ST_ABBR", "COUNTY"), backward: str = "county"
) -> DataFrame:
    """Fill missing state and county names of areas.

    Forward within the county in FIPS order. Backward either inside the county
    (default), or over the whole table (``backward="global"``): the name of the next
    area that has one, even in the next county. The global step works on one row per
    county and then one per state, so the areas themselves are never gathered.
    """
    county = ["State_FIPS", "County_FIPS"]
    ordered = Window.partitionBy(*county).orderBy("FIPS")
    past = ordered.rowsBetween(Window.unboundedPreceding, 0)
    future = ordered.rowsBetween(0, Window.unboundedFollowing)
    out = areas
    for n in names:
        forward = F.last(n, ignorenulls=True).over(past)
        out = out.withColumn(f"_{n}", F.coalesce(forward, F.first(n, ignorenulls=True).over(future)))
    if backward == "global":
        # names are gathered per county, so one whole-county gap is left to fill
        counties = areas.groupBy(*county).agg(*[_first_value(n).alias(n) for n in names])
        states = counties.groupBy("State_FIPS").agg(
            *[F.min_by(n, F.when(F.col(n).isNotNull(), F.col("County_FIPS"))).alias(n) for n in names]
        )
        in_state = Window.partitionBy("State_FIPS").orderBy("County_FIPS").rowsBetween(1, Window.unboundedFollowing)
        of_states = Window.orderBy("State_FIPS").rowsBetween(1, Window.unboundedFollowing)
        next_county = counties.select(
            *county, *[F.first(n, ignorenulls=True).over(in_state).alias(f"c_{n}") for n in names]
        )
        next_state = states.select(
            "State_FIPS", *[F.first(n, ignorenulls=True).over(of_states).alias(f"s_{n}") for n in names]
        )
        out = out.join(next_county, county, "left").join(next_state, "State_FIPS", "left")
        for n in names:
            out = out.withColumn(f"_{n}", F.coalesce(f"_{n}", f"c_{n}", f"s_{n}"))
    elif backward != "county":
        raise ValueError("backward must be 'county' or 'global'")
    return out.select(*[F.col(f"_{c}").alias(c) if c in names else F.col(c) for c in areas.columns])


def final_columns(labels: Sequence[str]) -> list[str]:
    return list(
        dict.fromkeys(
            ["ST_ABBR", "COUNTY", "State_FIPS", "County_FIPS", "FIPS", "Total_Num_Building"]
            + [count_column(s) for s in labels]
            + fixed.FINAL_SVI_COLUMNS
        )
    )


def final_output(areas: DataFrame, labels: Sequence[str]) -> DataFrame:
    """The report columns in their fixed order, repeated labels once."""
    return areas.select(*final_columns(labels))


def overview(final: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Population in the region, buildings and share per category in one row."""
    total = F.greatest(F.coalesce(F.sum("Total_Num_Building"), F.lit(0)), F.lit(1))
    cols = []
    for s in dict.fromkeys(labels):
        n = F.coalesce(F.sum(count_column(s)), F.lit(0))
        cols += [n.alias(f"n_{s}"), F.round(n * 100.0 / total, 1).alias(f"pct_{s}")]
    return final.agg(
        F.coalesce(F.sum("E_TOTPOP"), F.lit(0.0)).alias("total_population"),
        F.count(F.lit(1)).alias("areas"),
        *cols,
    )


def worst_damage(final: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Add the sum of the two worst category counts."""
    return final.withColumn(
        "worst_damage_assessment", F.col(count_column(labels[0])) + F.col(count_column(labels[1]))
    )


def join_boundaries(final: DataFrame, boundaries: DataFrame) -> DataFrame:
    """Areas that have a boundary, with the boundary's columns."""
    return boundaries.join(final, F.col("GEOID") == F.col("FIPS"))


def classify(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    return df.withColumn("damage_category", impact.depth_category(F.col("depth_grid"), labels))


def area_table(
    results: DataFrame,
    blocks: DataFrame,
    svi: DataFrame,
    labels: Sequence[str],
    building_types: Sequence[str] | Mapping[str, str],
    geography: str = "county",
    null_geoid: str = "null",
    backward: str = "county",
    dedup_keys: Sequence[str] = ("fltyid",),
) -> DataFrame:
    """Results to the final area table: dedup, blocks, residential, counts, SVI, names.

    ``results`` has lower-case column names. Only the columns the table needs travel
    through the shuffles.
    """
    needed = [c for c in ("fltyid", "occ", "depth_grid", "bldgdmgpct") if c in results.columns]
    slim = results.select(*dict.fromkeys([*dedup_keys, *needed]))
    best = dedup_predictions(slim, dedup_keys)
    homes = inv.residential_filter(attach_blocks(best, blocks), building_types)
    placed = classify(with_geoids(homes, null_geoid), labels)
    areas = join_svi(damage_counts(placed, labels, geography), svi)
    return final_output(fill_names(areas, backward=backward), labels)
