"""Feature lines as a stream.

The row-wise operators (parsing, cleaning, damage of sampled rows) are stateless, so
they run on ``readStream`` unchanged. De-duplication and area tables need a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.inventory import engine_columns, require_fields
from tidemark.sources.inventory import parse_feature_lines


def read_feature_stream(spark: SparkSession, path: str, on_bad: str = "fail") -> DataFrame:
    """New feature files in a folder as a stream of inventory rows."""
    return parse_feature_lines(spark.readStream.text(path), on_bad)


def engine_stream(features: DataFrame) -> DataFrame:
    """Complete rows of a feature stream in the engine layout (not de-duplicated)."""
    return engine_columns(require_fields(features))


def write_feature_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet, exactly once; stops when the available files are done."""
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
