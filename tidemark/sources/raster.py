"""Rasters as pixel tables, and a reader that turns GeoTIFF files into one.

Runs read pixel tables. The GeoTIFF reader is the one-off step that fills them; it is
the only place where Python sees row data, because no built-in source decodes TIFF.
Supported: classic little- or big-endian TIFF, strips or tiles, no compression or
deflate, predictor 1, one band of integers or floats.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema

# TIFF and GeoTIFF tags.
WIDTH, HEIGHT, BITS, COMPRESSION, STRIP_OFFSETS, ROWS_PER_STRIP, STRIP_BYTES = 256, 257, 258, 259, 273, 278, 279
PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_BYTES, SAMPLE_FORMAT = 317, 322, 323, 324, 325, 339
PIXEL_SCALE, TIE_POINT, GEO_KEYS, NODATA = 33550, 33922, 34735, 42113
MODEL_TYPE_KEY, PROJECTED_CS_KEY = 1024, 3072
_FIELD = {1: "B", 2: "c", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d"}


def _tags(data: bytes) -> tuple[str, dict[int, tuple]]:
    order = {b"II": "<", b"MM": ">"}[data[:2]]
    magic, start = struct.unpack(order + "HI", data[2:8])
    if magic != 42:
        raise ValueError("not a classic TIFF file")
    (count,) = struct.unpack_from(order + "H", data, start)
    tags = {}
    for k in range(count):
        tag, kind, n = struct.unpack_from(order + "HHI", data, start + 2 + 12 * k)
        code = _FIELD.get(kind)
        if code is None:
            continue
        size = struct.calcsize(code) * n
        at = start + 2 + 12 * k + 8
        if size > 4:
            (at,) = struct.unpack_from(order + "I", data, at)
        tags[tag] = struct.unpack_from(f"{order}{n}{code}", data, at)
    return order, tags


def _geo_key(tags: dict, key: int) -> int | None:
    directory = tags.get(GEO_KEYS, ())
    for i in range(4, len(directory) - 3, 4):
        if directory[i] == key:
            return directory[i + 3]
    return None


def raster_header(data: bytes) -> dict:
    """Metadata row of one file (without its id)."""
    _, tags = _tags(data)
    sx, sy = tags[PIXEL_SCALE][:2]
    i, j, _, x, y, _ = tags[TIE_POINT][:6]
    mark = tags.get(NODATA)
    epsg = _geo_key(tags, PROJECTED_CS_KEY) or 0
    north, south = 32601 <= epsg <= 32660, 32701 <= epsg <= 32760
    return {
        "x0": x - i * sx,
        "y0": y + j * sy,
        "pixel_width": sx,
        "pixel_height": sy,
        "n_cols": tags[WIDTH][0],
        "n_rows": tags[HEIGHT][0],
        "nodata": float(b"".join(mark).split(b"\0")[0]) if mark else None,
        "projected": _geo_key(tags, MODEL_TYPE_KEY) == 1,
        "zone": epsg % 100 if north or south else None,
        "south": south,
    }


def pixel_blocks(data: bytes) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(first row, first column, values)`` of each strip or tile, one at a time."""
    order, tags = _tags(data)
    width, height = tags[WIDTH][0], tags[HEIGHT][0]
    packing = tags.get(COMPRESSION, (1,))[0]
    if packing not in (1, 8, 32946) or tags.get(PREDICTOR, (1,))[0] != 1:
        raise ValueError("only uncompressed or deflate TIFF without predictor is supported")
    letter = {1: "u", 2: "i", 3: "f"}[tags.get(SAMPLE_FORMAT, (1,))[0]]
    kind = np.dtype(f"{order}{letter}{tags[BITS][0] // 8}")
    if TILE_OFFSETS in tags:
        bw, bh = tags[TILE_WIDTH][0], tags[TILE_HEIGHT][0]
        offsets, sizes = tags[TILE_OFFSETS], tags[TILE_BYTES]
    else:
        bw, bh = width, tags.get(ROWS_PER_STRIP, (height,))[0]
        offsets, sizes = tags[STRIP_OFFSETS], tags[STRIP_BYTES]
    across = -(-width // bw)
    for k, (at, size) in enumerate(zip(offsets, sizes)):
        raw = data[at : at + size]
        raw = zlib.decompress(raw) if packing != 1 else raw
        block = np.frombuffer(raw, dtype=kind)
        block = block.reshape(-1, bw)
        r, c = (k // across) * bh, (k % across) * bw
        yield r, c, block[: height - r, : width - c]


def _id_of(path: str) -> str:
    return os.path.basename(path)


def _read_headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [{"raster_id": _id_of(p), **raster_header(bytes(b))} for p, b in zip(batch["path"], batch["content"])]
        yield pd.DataFrame(rows, columns=schema.RASTER_META.names)


def _read_pixels(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            data = bytes(content)
            mark = raster_header(data)["nodata"]
            for r, c, block in pixel_blocks(data):
                keep = np.isfinite(block)
                if mark is not None:
                    keep &= block != mark
                rr, cc = np.nonzero(keep)
                yield pd.DataFrame(
                    {
                        "raster_id": _id_of(path),
                        "r": (rr + r).astype("int32"),
                        "c": (cc + c).astype("int32"),
                        "value": block[rr, cc].astype("float64"),
                    }
                )


def _files(spark: SparkSession, path: str, parallelism: int | None) -> DataFrame:
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files if parallelism is None else files.repartition(parallelism, "path")


def read_raster_meta(spark: SparkSession, path: str, parallelism: int | None = None) -> DataFrame:
    """One metadata row per GeoTIFF file."""
    return _files(spark, path, parallelism).mapInPandas(_read_headers, schema.RASTER_META)


def read_raster_pixels(spark: SparkSession, path: str, parallelism: int | None = None) -> DataFrame:
    """Pixels that hold a value, one output batch per strip or tile."""
    return _files(spark, path, parallelism).mapInPandas(_read_pixels, schema.RASTER_PIXELS)


def read_pixel_table(spark: SparkSession, path: str, raster_ids=None) -> DataFrame:
    """Stored pixel table; ``raster_ids`` prunes its partitions."""
    df = spark.read.schema(schema.RASTER_PIXELS).parquet(path)
    return df if raster_ids is None else df.where(F.col("raster_id").isin(list(raster_ids)))


def write_pixel_table(pixels: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Pixel table partitioned by raster, files sorted by grid position."""
    (
        pixels.repartition("raster_id", F.floor(F.col("r") / 256))
        .sortWithinPartitions("raster_id", "r", "c")
        .write.mode(mode)
        .partitionBy("raster_id")
        .parquet(path)
    )

