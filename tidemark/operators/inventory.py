"""Inventory cleaning: schema, filters, defaults, de-duplication, engine layout."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schema
from tidemark.functions import fixed, text


def conform_schema(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """The 32 inventory columns in order, typed; absent ones are NULL.

    Names match without regard to case. ``x``/``y`` repeat longitude and latitude.
    """
    have = {c.lower(): c for c in df.columns}
    source = {"x": "longitude", "y": "latitude"}
    out = []
    for field in schema.INVENTORY.fields:
        if field.name == "processed_at":
            out.append((processed_at if processed_at is not None else F.current_timestamp()).alias(field.name))
            continue
        name = source.get(field.name, field.name)
        col = F.col(f"`{have[name]}`") if name in have else F.lit(None)
        out.append(col.cast(field.dataType).alias(field.name))
    return df.select(*out)


def schema_difference(df: DataFrame, required: Iterable[str]) -> list[str]:
    """Required names that the DataFrame does not have, sorted."""
    return sorted(set(required) - set(df.columns))


def check_schema(df: DataFrame, required: Iterable[str], on_missing: str = "raise") -> list[str]:
    """Missing column names; raises before any Spark action unless ``on_missing="report"``."""
    missing = schema_difference(df, required)
    if missing and on_missing == "raise":
        raise ValueError(f"missing columns: {missing}")
    return missing


def prune_columns(df: DataFrame) -> DataFrame:
    """Keep what the damage run needs, plus the coordinates."""
    return df.select(*fixed.KEPT_FEATURE_COLUMNS, "longitude", "latitude")


def lowercase_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def union_states(*frames: DataFrame) -> DataFrame:
    """Concatenate inventories by column name; columns absent in one become NULL."""
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def bbox_filter(
    df: DataFrame,
    xmin: float,
    ymin: float,
    xmax: float,
    ymax: float,
    lon: str = "longitude",
    lat: str = "latitude",
) -> DataFrame:
    """Points inside a closed rectangle; reaches the Parquet scan as range filters."""
    return df.where(F.col(lat).between(ymin, ymax) & F.col(lon).between(xmin, xmax))


def require_fields(df: DataFrame, columns: Sequence[str] = tuple(fixed.STRICT_REQUIRED_COLUMNS)) -> DataFrame:
    """Strict policy: drop rows where any of the columns is NULL (NaN is a value)."""
    keep = F.lit(True)
    for c in columns:
        keep = keep & F.col(c).isNotNull()
    return df.where(keep)


def fill_defaults(df: DataFrame) -> DataFrame:
    """Fill policy: only the id and latitude are needed, values get defaults."""
    return df.where(F.col("bid").isNotNull() & F.col("latitude").isNotNull()).fillna(fixed.FILL_DEFAULTS)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark limits each map task to one row per key before the shuffle
    (``WindowGroupLimit`` in the plan), so a key holding a large share of the rows
    sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def dedup_inventory(df: DataFrame, keys: Sequence[str] = ("bid",)) -> DataFrame:
    """Per building keep the row with the highest structure value.

    Ties are broken by all other columns, so the result does not depend on row order.
    """
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in (*keys, "val_struct")
        and isinstance(f.dataType, (T.NumericType, T.StringType, T.BooleanType, T.TimestampType))
    ]
    order = [F.col("val_struct").desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in rest]
    return keep_first(df, keys, order)


def engine_columns(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Project cleaned inventory rows to the ten engine columns (plus ``extra``)."""
    return df.select(
        F.col("bid").alias("FltyId"),
        text.occ_class(F.col("occtype")).alias("Occ"),
        F.col("val_struct").alias("Cost"),
        F.col("sqft").alias("Area"),
        F.col("num_story").alias("NumStories"),
        text.foundation_code(F.col("found_type")).alias("FoundationType"),
        F.col("found_ht").alias("FirstFloorHt"),
        F.coalesce(F.col("val_cont"), F.lit(0.0)).alias("ContentCost"),
        F.col("latitude").alias("Latitude"),
        F.col("longitude").alias("Longitude"),
        *extra,
    )


def apply_policy(df: DataFrame, policy: str) -> DataFrame:
    """``strict`` drops incomplete rows, ``fill`` replaces missing values."""
    if policy == "strict":
        return require_fields(df)
    if policy == "fill":
        return fill_defaults(df)
    raise ValueError("policy must be 'strict' or 'fill'")


def engine_input(
    inventory: DataFrame,
    bbox: tuple[float, float, float, float] | None = None,
    policy: str = "strict",
    extra: Sequence[str] = (),
) -> DataFrame:
    """Inventory to engine rows: clip, complete, de-duplicate, project.

    Filters come before the de-duplication: the best row *inside* the clip wins.
    """
    used = [*fixed.STRICT_REQUIRED_COLUMNS, "val_cont", *extra]
    df = inventory.select(*dict.fromkeys(used))
    df = df if bbox is None else bbox_filter(df, *bbox)
    if policy == "fill":
        # rank on the stored value: a missing value sorts last, not as zero
        df = df.where(F.col("bid").isNotNull() & F.col("latitude").isNotNull())
        return engine_columns(apply_policy(dedup_inventory(df), policy), extra)
    return engine_columns(dedup_inventory(apply_policy(df, policy)), extra)


def block_join_table(df: DataFrame) -> DataFrame:
    """Building id with its normalised census block."""
    return df.select(F.col("bid").alias("fltyid"), text.block_fips(F.col("cbfips")).alias("cbfips"))


def residential_filter(df: DataFrame, types: Sequence[str] | Mapping[str, str] = tuple(fixed.RESIDENTIAL_TYPES), occ: str = "occ") -> DataFrame:
    """Rows whose occupancy is listed, or flagged ``"Y"`` in a mapping."""
    if isinstance(types, Mapping):
        types = [k for k, flag in types.items() if flag == "Y"]
    return df.where(F.col(occ).isin(list(types)))


_LOGICAL = {
    "UserDefinedFltyId": ("f_id", "text"),
    "OCC": ("f_occ", "text"),
    "Cost": ("f_cost", "number"),
    "Area": ("f_area", "number"),
    "NumStories": ("f_stories", "number"),
    "FoundationType": ("f_foundation", "number"),
    "FirstFloorHt": ("f_height", "number"),
    "ContentCost": ("f_content", "number"),
    "BDDF_ID": ("f_bddf", "curve_id"),
    "CDDF_ID": ("f_cddf", "curve_id"),
    "IDDF_ID": ("f_iddf", "curve_id"),
    "InvCost": ("f_invcost", "number"),
    "SOID": ("f_soid", "text"),
    "Latitude": ("f_lat", "number"),
    "Longitude": ("f_lon", "number"),
}


def normalize_field_map(mapping: Mapping[str, str] | Sequence[str]) -> dict[str, str]:
    """All 15 logical names with a column name, ``""`` where none is supplied."""
    if isinstance(mapping, Mapping):
        values = [mapping.get(k, "") for k in fixed.FIELD_MAP_KEYS]
    elif isinstance(mapping, (list, tuple)):
        values = list(mapping)
    else:
        raise TypeError("field map must be a dict, list or tuple")
    if len(values) != len(fixed.FIELD_MAP_KEYS):
        raise ValueError(f"field map needs exactly {len(fixed.FIELD_MAP_KEYS)} values: {fixed.FIELD_MAP_KEYS}")
    return {k: "" if v is None else str(v).strip() for k, v in zip(fixed.FIELD_MAP_KEYS, values)}


def _is_missing(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    if isinstance(kind, T.StringType):
        return text.normalize_value(c) == ""
    return c.isNull()


def _as_number(df: DataFrame, name: str) -> Column:
    """Typed columns skip the text route; missing counts as 0."""
    kind = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        return text.lenient_number(text.normalize_value(c))
    return F.when(_is_missing(df, name), F.lit(0.0)).otherwise(c.cast("double"))


def _as_curve_id(df: DataFrame, name: str) -> Column:
    """Curve ids compare as text; whole numbers lose a trailing ``.0``."""
    s = text.normalize_value(F.col(f"`{name}`"))
    return F.nullif(F.regexp_replace(s, r"[.]0+$", ""), F.lit(""))


def apply_field_map(df: DataFrame, mapping: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Add typed ``f_*`` columns for the mapped fields and ``f_missing`` for FLT-5.

    A field that is not supplied gets a NULL column of its type.
    """
    names = normalize_field_map(mapping)
    absent = [v for v in names.values() if v and v not in df.columns]
    if absent:
        raise ValueError(f"mapped columns not in the input: {absent}")
    missing = F.lit(False)
    for key in fixed.REQUIRED_ENGINE_FIELDS:
        if not names[key]:
            raise ValueError(f"required field is not mapped: {key}")
        alias, kind = _LOGICAL[key]
        # text fields are normalised once and then compared
        missing = missing | (F.col(alias) == "" if kind == "text" else _is_missing(df, names[key]))
    out = [F.col(f"`{c}`") for c in df.columns]
    for key, (alias, kind) in _LOGICAL.items():
        name = names[key]
        if not name:
            col = F.lit(None).cast("double" if kind == "number" else "string")
        elif kind == "number":
            col = _as_number(df, name)
        elif kind == "curve_id":
            col = _as_curve_id(df, name)
        else:
            col = text.normalize_value(F.col(f"`{name}`"))
        out.append(col.alias(alias))
    return df.select(*out).withColumn("f_missing", missing)


WORK_COLUMNS = [alias for alias, _ in _LOGICAL.values()] + ["f_missing"]
