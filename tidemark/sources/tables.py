"""Census, ground-truth and event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions import fixed


def _typed(raw: DataFrame, fields) -> DataFrame:
    """Cast named text columns; a value that does not parse becomes NULL."""
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields])


def read_svi(spark: SparkSession, path: str) -> DataFrame:
    """Vulnerability table: 20 named columns of the file, ``FIPS`` kept as text."""
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    return _typed(raw.select(*fixed.SVI_COLUMNS), schema.SVI.fields)


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    return _typed(raw, schema.GROUND_TRUTH_CSV.fields)


def read_validation_table(spark: SparkSession, path: str) -> DataFrame:
    """Estimates joined to recorded shelter counts, one row per event and county."""
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    return _typed(raw, schema.VALIDATION_CSV.fields)


def read_event_states(spark: SparkSession, path: str) -> DataFrame:
    """Event map from YAML: ``event, states array<string>, raster_pattern``.

    The file is a settings file of a few dozen lines. Spark reads it, from any file system.
    """
    import yaml

    body = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    rows = [(name, list(e["states"]), e.get("raster_pattern")) for name, e in yaml.safe_load(body)["events"].items()]
    return spark.createDataFrame(rows, "event string, states array<string>, raster_pattern string")
