"""Pixels as tile arrays in bucketed storage, looked up by tile and offset.

A tile is a square of pixels in one row ``(raster_id, tile, copy, cells)``. The table is bucketed and
sorted by the first three, so a join reads it in place: buildings move to the buckets, pixels never
move. ``copies`` stores each tile so many times, under numbers that buildings pick by hash, which
splits a tile with a large share of all buildings over as many tasks.

A session whose shuffles have more partitions than the table has buckets moves the tiles after all;
write with at least as many buckets as the largest run has partitions.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["raster_id", "tile", "copy"]
SHAPE = "raster_id STRING, tile BIGINT, copy INT, cells ARRAY<DOUBLE>"


@dataclass(frozen=True)
class TiledPixels:
    """A stored tile table and how its tiles were cut."""

    table: DataFrame
    size: int
    copies: int

    def where_raster(self, keep: Callable[[Column], Column]) -> TiledPixels:
        return TiledPixels(self.table.where(keep(F.col("raster_id"))), self.size, self.copies)


def tile_of(r: Column, c: Column, size: int) -> Column:
    return F.floor(r / size).cast("long") * F.lit(1 << 32) + F.floor(c / size).cast("long")


def offset_in(r: Column, c: Column, size: int) -> Column:
    return (F.pmod(r, F.lit(size)) * size + F.pmod(c, F.lit(size))).cast("int")


def pixel_tiles(pixels: DataFrame, size: int = 32, copies: int = 1) -> DataFrame:
    """Long pixel rows to tile rows; a pixel without a row is NULL. A pixel given twice is an error."""
    r, c = F.col("r"), F.col("c")
    cut = pixels.where(F.col("value").isNotNull()).select("raster_id", tile_of(r, c, size).alias("tile"), F.struct(offset_in(r, c, size).alias("at"), F.col("value").cast("double").alias("value")).alias("p"))
    # a group holds size * size pixels at most
    held = cut.groupBy("raster_id", "tile").agg(F.map_from_entries(F.collect_list("p")).alias("by"))
    cells = F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), lambda i: F.element_at("by", i))
    return held.select("raster_id", "tile", cells.alias("cells")).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).select(*KEYS, "cells")


def write_tiles(pixels: DataFrame, root: str, size: int = 32, copies: int = 1, buckets: int | None = None) -> None:
    """Tile table under ``root/tiles``, its layout under ``root/layout``. Refuses an existing one."""
    spark = pixels.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"tiles_{uuid.uuid4().hex}"
    # a task holds whole buckets, so a bucket is one file
    dealt = pixel_tiles(pixels, size, copies).repartition(n, *KEYS)
    dealt.write.mode("errorifexists").bucketBy(n, *KEYS).sortBy(*KEYS).option("path", f"{root}/tiles").format("parquet").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    spark.range(1).selectExpr(f"{size} AS size", f"{copies} AS copies", f"{n} AS buckets").write.parquet(f"{root}/layout")


def read_tiles(spark: SparkSession, root: str) -> TiledPixels:
    """The stored tiles, registered in the session's catalog with their buckets."""
    layout = spark.read.parquet(f"{root}/layout").first()
    name = f"tiles_{uuid.uuid4().hex}"
    keys = ", ".join(KEYS)
    place = f"{root}/tiles".replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({SHAPE}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {layout.buckets} BUCKETS LOCATION '{place}'")
    return TiledPixels(spark.table(name), layout.size, layout.copies)


def look_up(located: DataFrame, pixels: TiledPixels, seed: str | None = None) -> DataFrame:
    """Adds ``value`` of the pixel ``(r, c)`` under each row, NULL where there is none.

    Rows outside the grid match no tile; they are dealt by hash, not to one task.
    """
    names = [c for c in ("f_id", "FltyId", "bid", "id") if c in located.columns] if seed is None else [seed]
    spread = F.xxhash64(*names) if names else F.xxhash64("r", "c")
    r, c = F.col("r"), F.col("c")
    keyed = located.withColumns(
        {
            "tile": F.when(F.col("in_grid"), tile_of(r, c, pixels.size)).otherwise(-1 - F.pmod(spread, F.lit(1 << 20))),
            "copy": F.pmod(spread, F.lit(pixels.copies)).cast("int"),
            "_at": F.when(F.col("in_grid"), offset_in(r, c, pixels.size)),
        }
    )
    found = keyed.join(pixels.table, KEYS, "left")
    return found.withColumn("value", F.get("cells", "_at")).drop("tile", "copy", "cells", "_at")
