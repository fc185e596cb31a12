"""Lookup tables from caller-supplied CSV files."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions import fixed
from tidemark.operators.curves import Lookups


def _csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("escape", '"').csv(path)


def _curve() -> Column:
    return F.array(*[F.col(c).try_cast("double") for c in fixed.CURVE_COLUMNS]).alias("curve")


def load_curves(
    spark: SparkSession,
    path: str,
    kind: str,
    zone: str,
    key: str = "SpecificOccupId",
    ddf_id: str = "DDF_ID",
) -> DataFrame:
    """Default curves of one kind and zone, one row per key in file order.

    ``pos`` keeps the file order, so that the first of several equal keys wins.
    """
    return _csv(spark, path).select(
        F.lit(kind).alias("kind"),
        F.lit(zone).alias("zone"),
        F.trim(F.col(key)).alias("key"),
        F.trim(F.col(ddf_id)).alias("ddf_id"),
        F.trim(F.col("Occupancy")).alias("occupancy"),
        _curve(),
        F.monotonically_increasing_id().alias("pos"),
    )


def load_library(spark: SparkSession, path: str, kind: str, ddf_id: str) -> DataFrame:
    """The full curve library of one kind, for curves chosen by the user."""
    return _csv(spark, path).select(
        F.lit(kind).alias("kind"),
        F.trim(F.col(ddf_id)).alias("ddf_id"),
        F.trim(F.col("Occupancy")).alias("occupancy"),
        _curve(),
        F.monotonically_increasing_id().alias("pos"),
    )


def load_dimension(spark: SparkSession, path: str, name: str) -> DataFrame:
    """``debris``, ``restoration`` or ``sales`` rates; text keys are trimmed."""
    table = {
        "debris": schema.DEBRIS_CSV,
        "restoration": schema.RESTORATION_CSV,
        "sales": schema.SALES_CSV,
    }[name]
    raw = _csv(spark, path)
    return raw.select(
        *[
            (F.trim(F.col(f.name)) if f.dataType.typeName() == "string" else F.col(f.name).try_cast(f.dataType)).alias(f.name)
            for f in table.fields
        ]
    )


def load_lookups(
    spark: SparkSession,
    curves: Mapping[tuple[str, str], str],
    debris: str,
    restoration: str,
    sales: str,
    library: Mapping[str, tuple[str, str]] | None = None,
) -> Lookups:
    """All lookups of a run. ``curves`` maps (kind, zone) to a file, ``library`` maps
    a kind to its file and id column."""
    defaults = [load_curves(spark, path, kind, zone) for (kind, zone), path in curves.items()]
    full = [load_library(spark, path, kind, col) for kind, (path, col) in (library or {}).items()]
    return Lookups(
        curves=reduce(DataFrame.unionByName, defaults),
        debris=load_dimension(spark, debris, "debris"),
        restoration=load_dimension(spark, restoration, "restoration"),
        sales=load_dimension(spark, sales, "sales"),
        library=reduce(DataFrame.unionByName, full) if full else None,
    )
