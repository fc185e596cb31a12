"""Run checks and comparison with historical records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed, text
from tidemark.operators.inventory import schema_difference

# Loss columns in the order they are tried, columns a result file needs.
LOSS_COLUMNS = ["BldgLoss", "BldgDmgPct", "TotalLoss", "bldg_loss"]
REQUIRED_RESULT_COLUMNS = ["FltyId", "Latitude", "Longitude", "state", "flc"]
ZERO_LOSS_WARN_PCT = 90


def loss_value(df: DataFrame) -> Column:
    """First non-empty loss column of the row as a number; unreadable or none is 0."""
    have = [c for c in LOSS_COLUMNS if c in df.columns]
    if not have:
        return F.lit(0.0)
    first = F.coalesce(*[F.nullif(F.col(c).cast("string"), F.lit("")) for c in have])
    return F.coalesce(text.lenient_number(first), F.lit(0.0))


def _label(df: DataFrame, *names: str) -> Column:
    for n in names:
        if n in df.columns:
            return F.coalesce(F.col(n).cast("string"), F.lit(""))
    return F.lit("?")


def prediction_summary(results: DataFrame) -> DataFrame:
    """Rows, zero-loss rows and loss for the whole run, by state, class and occupancy.

    One scan and one grouping-sets aggregation. ``dimension`` is ``total``, ``state``,
    ``flc`` or ``occ``.
    """
    base = results.select(
        _label(results, "state").alias("state"),
        _label(results, "flc").alias("flc"),
        _label(results, "Occ", "occ").alias("occ"),
        loss_value(results).alias("loss"),
    )
    grouped = base.groupingSets(
        [[], [F.col("state")], [F.col("flc")], [F.col("occ")]], F.col("state"), F.col("flc"), F.col("occ")
    ).agg(
        F.grouping_id().alias("_g"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("loss") <= 0).alias("zero_loss_rows"),
        F.round(F.sum("loss"), 2).alias("loss"),
    )
    dimension = (
        F.when(F.col("_g") == 7, F.lit("total"))
        .when(F.col("_g") == 3, F.lit("state"))
        .when(F.col("_g") == 5, F.lit("flc"))
        .otherwise(F.lit("occ"))
    )
    key = F.when(F.col("_g") == 3, F.col("state")).when(F.col("_g") == 5, F.col("flc")).when(F.col("_g") == 6, F.col("occ"))
    pct = F.coalesce(F.round(F.lit(100.0) * F.col("zero_loss_rows") / F.nullif(F.col("n_rows"), F.lit(0)), 2), F.lit(0.0))
    return grouped.select(
        dimension.alias("dimension"),
        key.alias("key"),
        "n_rows",
        "zero_loss_rows",
        pct.alias("zero_loss_pct"),
        F.coalesce("loss", F.lit(0.0)).alias("loss"),
    )


def top_occupancies(summary: DataFrame, n: int = 10) -> DataFrame:
    """Occupancies with most rows; equal counts in name order."""
    return (
        summary.where("dimension = 'occ'")
        .select(F.col("key").alias("occ"), "n_rows")
        .orderBy(F.col("n_rows").desc(), "occ")
        .limit(n)
    )


def _facts(summary: DataFrame) -> DataFrame:
    """The summary in one row. Maps hold one entry per state or flood class."""

    def of_total(column: str, default) -> Column:
        value = F.max(F.when(F.col("dimension") == "total", F.col(column)))
        return F.coalesce(value, F.lit(default)).alias("total_rows" if column == "n_rows" else column)

    def pairs(dimension: str, value: str) -> Column:
        entry = F.struct(F.col("key"), F.col(value))
        return F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("dimension") == dimension, entry))))

    return summary.where("dimension <> 'occ'").agg(
        of_total("n_rows", 0),
        of_total("zero_loss_rows", 0),
        of_total("zero_loss_pct", 0.0),
        pairs("state", "n_rows").alias("rows_by_state"),
        pairs("flc", "n_rows").alias("rows_by_flc"),
        pairs("state", "loss").alias("damage_by_state"),
    )


def _issues() -> Column:
    some = F.col("total_rows") > 0
    warning = F.concat(F.lit("WARN: "), F.col("zero_loss_pct").cast("string"), F.lit("% zero-loss rows"))
    return F.array_compact(
        F.array(
            F.when(~some, F.lit("FAIL: no prediction rows")),
            F.when(some & (F.col("zero_loss_pct") > ZERO_LOSS_WARN_PCT), warning),
            F.when(some & (F.size("rows_by_state") == 0), F.lit("FAIL: no states in output")),
            F.when(some & (F.size("rows_by_flc") == 0), F.lit("FAIL: no flood classes in output")),
        )
    )


def _passed(issues: str) -> Column:
    return ~F.exists(issues, lambda i: i.startswith("FAIL"))


def validation_checks(summary: DataFrame) -> DataFrame:
    """One row: ``total_rows, zero_loss_pct, issues array<string>, passed``."""
    return (
        _facts(summary)
        .withColumn("issues", _issues())
        .select("total_rows", "zero_loss_pct", "issues", _passed("issues").alias("passed"))
    )


def validation_report(results: DataFrame, file: str = "") -> DataFrame:
    """One row with a JSON report of summary, issues and the passed flag."""
    missing = schema_difference(results, REQUIRED_RESULT_COLUMNS)
    summary = prediction_summary(results)
    top = top_occupancies(summary).agg(F.collect_list(F.struct("occ", "n_rows")))
    schema_issues = F.array(*[F.lit(f"FAIL: missing columns: {missing}")] if missing else []).cast("array<string>")
    body = F.struct(
        F.lit(file).alias("file"),
        F.struct(
            "total_rows",
            "zero_loss_rows",
            "zero_loss_pct",
            "rows_by_state",
            "rows_by_flc",
            F.map_from_entries(F.col("_top")).alias("rows_by_occ_top10"),
            "damage_by_state",
        ).alias("summary"),
        F.col("issues"),
        _passed("issues").alias("passed"),
    )
    facts = _facts(summary).withColumn("_top", top.scalar())
    return facts.withColumn("issues", F.concat(schema_issues, _issues())).select(F.to_json(body).alias("report"))


def accuracy_metrics(df: DataFrame, truth: str, estimate: str, event: str = "event") -> DataFrame:
    """n, RMSE, MAE, R², means; per event and overall (``event`` NULL).

    Built from sums and a merged variance (a difference of raw sums of squares would cancel), so it is
    one rollup with partial aggregation.
    """
    err = F.col(estimate) - F.col(truth)
    g = F.col(truth)
    sums = (
        df.select(event, truth, estimate)
        .where(g.isNotNull() & F.col(estimate).isNotNull())
        .rollup(event)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(err * err).alias("_sse"),
            F.sum(F.abs(err)).alias("_sae"),
            F.sum(g).alias("_g"),
            F.var_pop(g).alias("_var"),
            F.sum(estimate).alias("_e"),
        )
    )
    n = F.col("n")
    spread = F.col("_var") * n
    return sums.select(
        F.col(event),
        n,
        F.sqrt(F.col("_sse") / n).alias("rmse"),
        (F.col("_sae") / n).alias("mae"),
        F.when(spread > 0, 1 - F.col("_sse") / spread).alias("r2"),
        (F.col("_g") / n).alias("mean_truth"),
        (F.col("_e") / n).alias("mean_estimate"),
    )


def join_ground_truth(estimates: DataFrame, truth: DataFrame, keys: Sequence[str]) -> DataFrame:
    return estimates.join(truth, list(keys))


def coverage(predicted: DataFrame, truth: DataFrame, keys: Sequence[str] = ("event", "state", "county")) -> DataFrame:
    """Truth keys flagged by whether any prediction has them."""
    keys = list(keys)
    seen = predicted.select(*keys).distinct().withColumn("_seen", F.lit(True))
    return truth.select(*keys).distinct().join(seen, keys, "left").select(*keys, F.col("_seen").isNotNull().alias("matched"))


def matched_counties(predicted: DataFrame, truth: DataFrame, keys: Sequence[str]) -> DataFrame:
    return predicted.select(*keys).intersect(truth.select(*keys))


def missed_counties(predicted: DataFrame, truth: DataFrame, keys: Sequence[str]) -> DataFrame:
    return truth.select(*keys).distinct().join(predicted.select(*keys).distinct(), list(keys), "left_anti")


def coverage_rate(flagged: DataFrame, by: Sequence[str] = ("event", "state")) -> DataFrame:
    """Matched and total truth counties with their ratio."""
    return (
        flagged.groupBy(*by)
        .agg(F.count_if("matched").alias("matched"), F.count(F.lit(1)).alias("gt_total"))
        .withColumn("coverage_rate", F.col("matched") / F.col("gt_total"))
    )


def sanity_checks(df: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Violations per rule on a table with affected, impacted and county population."""
    rules = {}
    for z in ("low", "medium", "high"):
        rules[f"pop_impacted_{z} <= pop_affected_{z}"] = (
            F.col(f"pop_impacted_{z}") > F.col(f"pop_affected_{z}") + tolerance
        )
    affected = F.col("pop_affected_low") + F.col("pop_affected_medium") + F.col("pop_affected_high")
    impacted = F.col("pop_impacted_low") + F.col("pop_impacted_medium") + F.col("pop_impacted_high")
    rules["zero affected has zero impacted"] = (affected == 0) & (impacted > 0)
    rules["affected <= county population"] = affected > F.col("census_pop") + tolerance
    wide = df.agg(*[F.count_if(v).alias(f"r{i}") for i, v in enumerate(rules.values())])
    parts = ", ".join(f"'{name}', r{i}" for i, name in enumerate(rules))
    out = wide.select(F.expr(f"stack({len(rules)}, {parts}) AS (check_name, violations)"))
    return out.withColumn("severity", F.when(F.col("violations") == 0, F.lit("OK")).otherwise(F.lit("ERROR")))


def largest_errors(df: DataFrame, truth: str, estimate: str, keys: Sequence[str], n: int = 10) -> DataFrame:
    """The ``n`` largest absolute errors with their direction."""
    gap = F.col(estimate) - F.col(truth)
    return (
        df.select(*keys, truth, estimate, F.abs(gap).alias("abs_error"), F.when(gap > 0, F.lit("OVER")).otherwise(F.lit("UNDER")).alias("direction"))
        .orderBy(F.col("abs_error").desc_nulls_last(), *keys)
        .limit(n)
    )


def top_counties(df: DataFrame, truth: str, keys: Sequence[str], columns: Sequence[str], n: int = 15) -> DataFrame:
    """The ``n`` counties with the largest recorded value."""
    return df.select(*keys, truth, *columns).orderBy(F.col(truth).desc_nulls_last(), *keys).limit(n)
