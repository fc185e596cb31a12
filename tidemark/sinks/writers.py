"""Sinks. Every writer refuses to replace existing data unless told to.

Spark's commit protocol writes to temporary paths and publishes on success, so a lost
executor or a failed job leaves no partial result behind. A table that is replaced stays
readable until the new one is complete (:mod:`tidemark.sinks.publish`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.damage import sort_by_depth
from tidemark.operators.naming import normalize_state
from tidemark.operators.validation import validation_report
from tidemark.sinks.publish import publish


# files that a task of predictions holds open, and bytes of a row group of each
OPEN_FILES, ROW_GROUP = 16, 16 << 20


# lines of one file of text: a packed file is read by one task
FILE_LINES = 1_000_000


def write_lines(lines: DataFrame, path: str, overwrite: bool = False, file_lines: int = FILE_LINES) -> None:
    """Text lines, packed, ``file_lines`` to a file at most; readers of text unpack them by themselves."""
    publish(lines, path, overwrite, lambda writer, to: writer.option("compression", "gzip").option("maxRecordsPerFile", file_lines).text(to))


def write_engine_input(df: DataFrame, path: str, overwrite: bool = False) -> int:
    """CSV with a header; returns the row count, observed during the write."""
    seen = Observation("engine_input")
    counted = df.observe(seen, F.count(F.lit(1)).alias("n_rows"))
    publish(counted, path, overwrite, lambda writer, to: writer.option("header", True).option("escape", '"').csv(to))
    return seen.get["n_rows"]


def write_inventory(df: DataFrame, root: str, overwrite: bool = False, cell: float = 0.5) -> None:
    """Snappy Parquet per state. Rows are range-partitioned by state and coarse place,
    which splits a large state over tasks and keeps row groups local in space."""
    place = [F.floor(F.col("latitude") / cell), F.floor(F.col("longitude") / cell)]
    dealt = df.repartitionByRange("state", *place).sortWithinPartitions("state", *place)
    publish(dealt, root, overwrite, lambda writer, to: writer.option("compression", "snappy").partitionBy("state").parquet(to))


def write_predictions(df: DataFrame, root: str, overwrite: bool = False) -> None:
    """Results partitioned by event and advisory; the grid name stays a column.

    Results are many times larger than what they are worked out from, so they are written where they
    are, neither shuffled nor sorted: a task holds up to ``OPEN_FILES`` files open, with small row groups,
    and sorts only what belongs to still more. An event and advisory gets a file from each task that
    has rows of it; fewer come from fewer tasks (``df.coalesce``).
    """
    conf, name = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    conf.set(name, OPEN_FILES)
    try:
        publish(
            df, root, overwrite, lambda writer, to: writer.option("compression", "zstd").option("parquet.block.size", ROW_GROUP).partitionBy("event", "adv").parquet(to)
        )
    finally:
        conf.set(name, before)


def result_name(inventory: str, raster: str) -> str:
    """Name of the results of one inventory on one raster."""
    return f"{inventory.split('.')[0]}_{raster.split('.')[0]}"


def write_sorted(df: DataFrame, path: str, overwrite: bool = False, tie: str = "FltyId") -> None:
    """Second copy, deepest first; files are in global order."""
    publish(sort_by_depth(df, tie), path, overwrite, lambda writer, to: writer.option("header", True).csv(to))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for text output."""
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_geo_output(df: DataFrame, path: str, fmt: str = "csv", overwrite: bool = False) -> None:
    """Final area table as CSV or as JSON records, doubles to six decimals."""
    if fmt == "csv":
        publish(rounded(df), path, overwrite, lambda writer, to: writer.option("header", True).option("escape", '"').csv(to))
    elif fmt == "json":
        publish(rounded(df), path, overwrite, lambda writer, to: writer.option("ignoreNullFields", False).json(to))
    else:
        raise ValueError("fmt must be 'csv' or 'json'")


def manifest(source: DataFrame, output: DataFrame) -> DataFrame:
    """Rows per state before and after processing, with the share kept."""
    before = source.groupBy("state").agg(F.count(F.lit(1)).alias("feature_count"))
    after = output.groupBy("state").agg(F.count(F.lit(1)).alias("output_rows"))
    return (
        before.join(after, "state", "left")
        .fillna({"output_rows": 0})
        .select("state", F.replace("state", F.lit(" "), F.lit("_")).alias("state_path"), "feature_count", "output_rows")
    )


def stored_files(df: DataFrame, *keys: str) -> DataFrame:
    """Files of a file-based frame: ``file, bytes, written_at, n_rows``, by ``keys`` where given.

    Sizes and times come from Spark's file metadata column, so no folder is listed by hand.
    """
    meta = F.col("_metadata")
    rows = df.select(*keys, meta.file_path.alias("file"), meta.file_size.alias("bytes"), meta.file_modification_time.alias("written_at"))
    return rows.groupBy(*keys, "file", "bytes", "written_at").agg(F.count(F.lit(1)).alias("n_rows"))


def stored_states(df: DataFrame, state: Column | None = None) -> DataFrame:
    """Rows, files and bytes of each state in a file-based frame: ``state, n_rows, n_files, n_bytes``.

    A file that holds several states counts for each. Without a ``state`` column give an expression.
    """
    named = df if state is None else df.withColumn("state", state)
    files = stored_files(named, "state")
    return files.groupBy("state").agg(
        F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("n_bytes")
    )


def state_manifest(raw: DataFrame, stored: DataFrame, raw_state: Column | None = None) -> DataFrame:
    """One row per state of the raw files: names and codes, rows and bytes read and stored.

    Both frames are file-based: feature lines (or any raw files) and the stored inventory. A state
    that no table of names has keeps NULL codes; one that was not stored has zero rows and bytes.
    """
    before = stored_states(raw, raw_state).selectExpr("state", "n_rows AS feature_count", "n_files AS raw_files", "n_bytes AS raw_bytes")
    after = stored_states(stored).selectExpr("state", "n_rows AS output_rows", "n_files AS output_files", "n_bytes AS output_bytes")
    both = before.join(after, "state", "left").fillna(0, ["output_rows", "output_files", "output_bytes"])
    named = normalize_state(both, "state").withColumn("state_path", F.replace("state", F.lit(" "), F.lit("_")))
    return named.select("state", "state_path", "abbr", "fips", "feature_count", "raw_files", "raw_bytes", "output_rows", "output_files", "output_bytes")


def manifest_json(states: DataFrame, **run: str) -> DataFrame:
    """One JSON line per state with the run's metadata and time."""
    meta = [F.lit(str(v)).alias(k) for k, v in run.items()]
    body = F.struct(F.current_timestamp().alias("generated_at"), *meta, *states.columns)
    return states.select(F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def write_manifest(states: DataFrame, path: str, overwrite: bool = False, **run: str) -> None:
    publish(manifest_json(states, **run), path, overwrite, lambda writer, to: writer.text(to))


def write_validation_report(results: DataFrame, path: str, overwrite: bool = False, file: str = "") -> None:
    publish(validation_report(results, file), path, overwrite, lambda writer, to: writer.text(to))
