"""States, storms, archives and settings: joins on normalised names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import fixed, text


def state_table(spark: SparkSession) -> DataFrame:
    """The states with one row per accepted spelling: ``token, name, abbr, fips``."""
    rows = ", ".join(f"('{name}', '{abbr}', '{fips}')" for name, abbr, fips in fixed.US_STATES)
    states = spark.sql(f"SELECT * FROM VALUES {rows} AS t(name, abbr, fips)")
    return states.withColumn("token", F.explode(F.array("fips", "abbr", F.lower("name"))))


def normalize_state(df: DataFrame, column: str) -> DataFrame:
    """Add ``name, abbr, fips`` of a state given in any spelling; unknown gives NULL."""
    lookup = state_table(df.sparkSession)
    return df.withColumn("token", text.state_token(F.col(column))).join(lookup, "token", "left").drop("token")


def unknown_states(df: DataFrame, column: str) -> DataFrame:
    """Distinct spellings that name no state."""
    lookup = state_table(df.sparkSession).select("token")
    return (
        df.select(column)
        .distinct()
        .withColumn("token", text.state_token(F.col(column)))
        .join(lookup, "token", "left_anti")
        .select(column)
    )


def stable_distinct(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """Remove repeats, keep the first position of each key, in position order.

    The order is a range-partitioned sort over the distinct keys.
    """
    return df.groupBy(*keys).agg(F.min(pos).alias(pos)).orderBy(pos)


def candidate_archives(requests: DataFrame) -> DataFrame:
    """Ordered archive names per request ``(storm_id, advisory, year)``.

    ``tier`` 0 names the advisory itself, 1 the latest file; ``rank`` is the order.
    """
    normalized = text.storm_id(F.col("storm_id"), F.col("year"))
    names = text.archive_names(F.col("normalized_id"), F.col("advisory"), F.col("year"))
    return (
        requests.withColumn("normalized_id", normalized)
        .select(*requests.columns, "normalized_id", F.posexplode(names).alias("rank", "_n"))
        .select(*requests.columns, "normalized_id", "rank", F.col("_n.name").alias("name"), F.col("_n.tier").alias("tier"))
    )


def resolve_archives(candidates: DataFrame, links: DataFrame, keys: list[str], base_url: str | None = None) -> DataFrame:
    """Links of the best tier that is available for each request.

    ``links``: ``name, url``, one row per file name. A request has at most six names. With
    ``base_url``, a request without any link gets all its names under that address to try, in
    tier ``GUESSED``; without it such a request is left out.
    """
    found = candidates.join(links, "name", "left" if base_url else "inner")
    tier = F.when(F.col("url").isNotNull(), F.col("tier")).otherwise(F.lit(GUESSED))
    found = found.withColumn("tier", tier).withColumn("_best", F.min("tier").over(Window.partitionBy(*keys)))
    url = F.coalesce("url", F.concat(F.lit(base_url or ""), "name"))
    return found.where(F.col("tier") == F.col("_best")).select(*keys, "rank", "name", url.alias("url"), "tier")


# tier of names that no index page confirms
GUESSED = 99


def last_advisories(files: DataFrame, storm: str = "storm_id", name: str = "name", n: int = 3) -> DataFrame:
    """The last ``n`` file names per storm in lexical order."""
    window = Window.partitionBy(storm).orderBy(F.col(name).desc())
    distinct = files.select(storm, name).distinct()
    return distinct.withColumn("rn", F.row_number().over(window)).where(F.col("rn") <= n)


def overlay_params(defaults: DataFrame, overrides: DataFrame) -> DataFrame:
    """Settings as ``key, value`` rows: an override wins, also when it is NULL."""
    mine = overrides.select("key", F.col("value").alias("_new"), F.lit(True).alias("_set"))
    value = F.when(F.col("_set"), F.col("_new")).otherwise(F.col("value"))
    return defaults.join(mine, "key", "full_outer").select("key", value.alias("value"))


def explode_event_states(events: DataFrame) -> DataFrame:
    """One row per event and state from ``event, states array<string>``."""
    return events.select("event", "raster_pattern", F.explode("states").alias("state"))


def rasters_of_events(events: DataFrame, rasters: DataFrame) -> DataFrame:
    """Rasters whose name starts with the event's pattern, without regard to case."""
    named = rasters.withColumn("event_key", F.upper(text.raster_event(F.col("raster_id"))))
    keyed = events.withColumn("event_key", F.upper("raster_pattern"))
    return named.join(keyed, "event_key").drop("event_key")
