"""Inventory readers: Parquet by state, CSV, feature lines and feature collections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schema
from tidemark.functions import text


def read_inventory(
    spark: SparkSession,
    root: str | Sequence[str],
    states: Sequence[str] | None = None,
    table_schema: T.StructType = schema.INVENTORY_WITH_STATE,
) -> DataFrame:
    """Parquet inventory partitioned by ``state``; ``states`` prunes directories."""
    paths = [root] if isinstance(root, str) else list(root)
    df = spark.read.schema(table_schema).parquet(*paths)
    return df if states is None else df.where(F.col("state").isin(list(states)))


def read_inventory_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, all values text. Column names come from the header line."""
    return spark.read.option("header", True).option("escape", '"').csv(path)


def read_inventory_auto(spark: SparkSession, path: str) -> DataFrame:
    """Parquet for ``.parquet`` and ``.pq`` paths, CSV otherwise."""
    if path.lower().rstrip("/").endswith((".parquet", ".pq")):
        return spark.read.parquet(path)
    return read_inventory_csv(spark, path)


def is_feature(parsed: Column) -> Column:
    return F.coalesce(parsed["type"] == "Feature", F.lit(False))


def parse_feature_lines(lines: DataFrame, on_bad: str = "fail") -> DataFrame:
    """Newline-delimited GeoJSON features in column ``value`` to inventory rows.

    Blank lines are ignored. Bad JSON fails the job. An entry that is not a feature
    fails under ``on_bad="fail"`` and is left out under ``"skip_non_feature"``. A
    geometry other than a point has NULL coordinates. Works on streaming frames too.
    """
    corrupt = "_corrupt_record"
    shape = T.StructType(schema.FEATURE.fields + [T.StructField(corrupt, T.StringType())])
    line = text.strip(F.col("value"))
    parsed = F.from_json(line, shape, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    rows = lines.where(line != "").select(line.alias("value"), parsed.alias("f"))
    broken = F.col(f"f.{corrupt}").isNotNull() | F.col("f").isNull()
    # arrays and bare values are JSON but no objects
    is_object = F.col("value").startswith("{")
    bad_json = broken & (is_object | F.try_parse_json("value").isNull())
    if on_bad == "fail":
        state = F.when(bad_json, F.raise_error(F.lit("invalid JSON in feature stream"))).when(
            ~is_feature(F.col("f")), F.raise_error(F.lit("entry is not a GeoJSON feature"))
        )
        keep = state.cast("boolean").isNull()
    elif on_bad == "skip_non_feature":
        state = F.when(bad_json, F.raise_error(F.lit("invalid JSON in feature stream")))
        keep = state.cast("boolean").isNull() & is_feature(F.col("f"))
    else:
        raise ValueError("on_bad must be 'fail' or 'skip_non_feature'")
    good = rows.where(keep)
    return _feature_columns(good, "f")


def _feature_columns(df: DataFrame, column: str) -> DataFrame:
    point = F.col(f"{column}.geometry.type") == "Point"
    at = F.col(f"{column}.geometry.coordinates")
    return df.select(
        f"{column}.properties.*",
        F.when(point, F.get(at, F.lit(0))).alias("longitude"),
        F.when(point, F.get(at, F.lit(1))).alias("latitude"),
    )


def read_feature_lines(spark: SparkSession, path: str, on_bad: str = "fail") -> DataFrame:
    """Feature lines from files. In strict mode an empty stream fails as well."""
    lines = spark.read.text(path)
    if on_bad == "fail" and lines.where(text.strip(F.col("value")) != "").isEmpty():
        raise ValueError("empty feature stream")
    return parse_feature_lines(lines, on_bad)


COLLECTION = T.StructType(
    [T.StructField("type", T.StringType()), T.StructField("features", T.ArrayType(schema.FEATURE))]
)


def parse_feature_collections(docs: DataFrame) -> DataFrame:
    """GeoJSON documents in column ``value``, each with a ``features`` array, to rows."""
    parsed = F.from_json("value", COLLECTION, {"mode": "FAILFAST"})
    return _feature_columns(docs.select(F.explode(parsed["features"]).alias("f")), "f")


# What stands between two features of a document whose features begin with their type.
FEATURE_MARK = '"Feature"'


def parse_feature_pieces(pieces: DataFrame) -> DataFrame:
    """What lies between the marks ``"Feature"`` of GeoJSON documents, in column ``value``, to rows.

    A piece begins with the rest of one feature and ends with what leads to the next. Pieces that
    open a document hold no feature. A feature that does not begin with its type, or that is no
    sound JSON, fails the job; so does a property whose whole value is the mark.
    """
    piece = text.strip(F.regexp_replace("value", "^\\x{FEFF}", ""))
    head = piece.startswith("{")
    opens = piece.rlike(r'\{\s*"type"\s*:$')
    closes = piece.rlike(r"\}\s*\][^\[]*\}$") | piece.rlike(r"\}$")
    bad = F.when(head & ~opens & piece.contains('"features"') & ~piece.rlike(r'"features"\s*:\s*\[\s*\]'), F.lit("features do not begin with their type")).when(
        ~head & ~(piece.startswith(",") & (opens | closes)), F.lit("a feature does not begin with its type")
    )
    ok = F.when(bad.isNotNull(), F.raise_error(F.concat(bad, F.lit(": read the documents whole"))).cast("boolean")).otherwise(~head)
    found = pieces.where(piece != "").where(ok)
    whole = F.concat(F.lit('{"type":"Feature"'), piece)
    return _feature_columns(found.select(F.from_json(whole, schema.FEATURE, {"mode": "FAILFAST"}).alias("f")), "f")


def read_feature_collection(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """GeoJSON documents, one or more files, each with a ``features`` array.

    The mark between features serves as record separator, so one large document is read by many
    tasks and is never one string. ``whole`` parses each file as one value instead, for documents
    whose features do not begin with their type.
    """
    if whole:
        return parse_feature_collections(spark.read.text(path, wholetext=True))
    return parse_feature_pieces(spark.read.option("lineSep", FEATURE_MARK).text(path))


def feature_lines(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Inventory rows to feature lines in column ``value`` (plus ``extra``): the inverse of parsing."""
    names = [c for c in df.columns if c in schema.FEATURE_PROPERTIES.names]
    body = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(
            F.lit("Point").alias("type"), F.array("longitude", "latitude").alias("coordinates")
        ).alias("geometry"),
        F.struct(*names).alias("properties"),
    )
    return df.select(F.to_json(body).alias("value"), *extra)

