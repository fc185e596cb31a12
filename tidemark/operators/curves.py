"""Damage curve and rate lookups, kept as DataFrames supplied by the caller."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed


KINDS = {"building": "b", "content": "k", "inventory": "i"}


def first_match(df: DataFrame, keys: list[str], values: list[str], pos: str = "pos") -> DataFrame:
    """One row per key: the one that comes first in its table."""
    packed = F.min_by(F.struct(*values), F.col(pos)).alias("_v")
    return df.groupBy(*keys).agg(packed).select(*keys, "_v.*")


def position(table: DataFrame) -> list[str]:
    return ["pos"] if "pos" in table.columns else []


def one_per_key(rates: DataFrame, keys: list[str]) -> DataFrame:
    """First row per key by ``pos``. A table without positions is taken to have one row per key."""
    values = [c for c in rates.columns if c not in (*keys, "pos")]
    return first_match(rates, keys, values) if "pos" in rates.columns else rates.dropDuplicates(keys)


def default_curves(curves: DataFrame) -> DataFrame:
    """One row per (zone, key) with the curve id and points of every kind.

    Building, content and inventory share the key, so a damage run joins once instead
    of three times. Input: ``kind, zone, key, ddf_id, curve, pos``.
    """
    aggregates = []
    for kind, p in KINDS.items():
        mine = F.when(F.col("kind") == kind, F.col("pos"))
        aggregates.append(F.min_by(F.struct("ddf_id", "curve"), mine).alias(p))
    wide = curves.groupBy("zone", F.col("key").alias("SOID")).agg(*aggregates)
    out: list[Column] = []
    for p in KINDS.values():
        out += [F.col(f"{p}.ddf_id").alias(f"{p}_id"), F.col(f"{p}.curve").alias(f"{p}_curve")]
    return wide.select("zone", "SOID", *out)


def curve_steps(df: DataFrame, keys: list[str], curves: list[str]) -> DataFrame:
    """One row per key and whole foot instead of one array per key.

    ``low`` is the point below a depth; each curve ``x`` becomes its value there
    (``x_lo``) and at the next point (``x_hi``, the same at the top). Joined by key and
    ``low``, a building row receives two numbers per curve rather than 29.
    """
    points = F.sequence(F.lit(0), F.lit(len(fixed.CURVE_COLUMNS) - 1))
    stepped = df.withColumn("low", F.explode(points))
    ends = []
    for c in curves:
        name = c.removesuffix("_curve")
        lo, hi = F.get(c, F.col("low")), F.get(c, F.col("low") + 1)
        ends += [lo.alias(f"{name}_lo"), F.coalesce(hi, lo).alias(f"{name}_hi")]
    return stepped.select(*keys, "low", *ends)


@dataclass
class Lookups:
    """The tables a damage run joins to. None is hinted: the planner broadcasts by byte statistics
    and adaptive execution by measured bytes, or splits a hot key of a shuffled join.

    ``curves``: ``kind, zone, key, ddf_id, curve, pos``; ``library`` (user-selectable
    curves): ``kind, ddf_id, occupancy, curve, pos``; ``debris``: ``DebrisID, Finishes,
    Structure, Foundation``; ``restoration``: ``RestFnID, Min_Restor_Days,
    Max_Restor_Days``; ``sales``: ``Occupancy, AnnualSalesPerSqFt, BusinessInvPctofSales``.
    """

    curves: DataFrame
    debris: DataFrame
    restoration: DataFrame
    sales: DataFrame
    library: DataFrame | None = None

    def default_side(self) -> DataFrame:
        wide = default_curves(self.curves)
        ids = [f"{p}_id" for p in KINDS.values()]
        steps = curve_steps(wide, ["zone", "SOID", *ids], [f"{p}_curve" for p in KINDS.values()])
        return steps

    def debris_side(self) -> DataFrame:
        rates = self.debris.select("DebrisID", "Finishes", "Structure", "Foundation", *position(self.debris))
        return one_per_key(rates, ["DebrisID"])

    def restoration_side(self) -> DataFrame:
        days = self.restoration.select("RestFnID", "Min_Restor_Days", "Max_Restor_Days", *position(self.restoration))
        return one_per_key(days, ["RestFnID"])

    def sales_side(self) -> DataFrame:
        sales = self.sales.select(F.col("Occupancy").alias("f_occ"), "AnnualSalesPerSqFt", "BusinessInvPctofSales", *position(self.sales))
        return one_per_key(sales, ["f_occ"])

    def library_side(self, kind: str) -> DataFrame:
        p = KINDS[kind]
        mine = first_match(self.library.where(F.col("kind") == kind), ["ddf_id"], ["occupancy", "curve"])
        named = mine.select(
            F.col("ddf_id").alias(f"u{p}_key"),
            F.col("occupancy").alias(f"u{p}_occ"),
            F.col("curve").alias(f"u{p}_curve"),
        )
        steps = curve_steps(named, [f"u{p}_key", f"u{p}_occ"], [f"u{p}_curve"])
        return steps


def curve_lookup(df: DataFrame, curves: DataFrame, kind: str) -> DataFrame:
    """Left lookup of one kind by ``zone`` and ``SOID``: adds ``ddf_id`` and ``curve``."""
    one = first_match(curves.where(F.col("kind") == kind), ["zone", "key"], ["ddf_id", "curve"])
    return df.join(one.withColumnRenamed("key", "SOID"), ["zone", "SOID"], "left")

