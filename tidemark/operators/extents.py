"""Many extents packed into few boxes that cover them, and counted.

Packing is a reduction: tasks hold a bounded number of boxes, merge the two whose common box adds
the least area until few are left, and pass these on. The last merge is over the boxes of all tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BOUNDS = ["xmin", "ymin", "xmax", "ymax"]


def _area(boxes: np.ndarray) -> np.ndarray:
    return (boxes[..., 2] - boxes[..., 0]) * (boxes[..., 3] - boxes[..., 1])


def _union(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    return np.concatenate([np.minimum(one[..., :2], others[..., :2]), np.maximum(one[..., 2:], others[..., 2:])], axis=-1)


def merge_boxes(boxes: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` boxes that cover all given ones: pairs that add the least area merge first."""
    boxes = np.unique(boxes.astype(float), axis=0)
    n = len(boxes)
    if n <= most:
        return boxes
    cost = _area(_union(boxes[:, None], boxes[None])) - _area(boxes)[:, None] - _area(boxes)[None]
    cost[np.diag_indices(n)] = np.inf
    alive = np.ones(n, bool)
    for _ in range(n - most):
        i, j = np.unravel_index(np.argmin(cost), cost.shape)
        boxes[i] = _union(boxes[i], boxes[j])
        alive[j] = False
        cost[j], cost[:, j] = np.inf, np.inf
        row = np.where(alive, _area(_union(boxes[i], boxes)) - _area(boxes[i]) - _area(boxes), np.inf)
        row[i] = np.inf
        cost[i], cost[:, i] = row, row
    return boxes[alive]


def reduce_boxes(parts: Iterable[np.ndarray], most: int, held: int = 8) -> np.ndarray:
    """:func:`merge_boxes` over any number of parts, with at most ``held * most`` boxes at a time."""
    out = np.zeros((0, 4))
    for part in parts:
        for at in range(0, len(part), held * most // 2):
            out = np.concatenate([out, part[at : at + held * most // 2]])
            if len(out) > held * most // 2:
                out = merge_boxes(out, held * most // 4)
    return merge_boxes(out, most)


@dataclass(frozen=True)
class Survey:
    """What a run knows of its rasters before it reads a building: boxes that cover the extents, the
    number of rasters, of pairs of raster and coarse cell, and of grid places (infinite where unknown)."""

    boxes: list[tuple[float, float, float, float]]
    rasters: float
    cells: float
    places: float


def survey(bounds: DataFrame, most: int = 32, cell: float = 1.0) -> Survey:
    """Packs and counts the extents. Raises where one is missing.

    Runs a job over the extents, one row per raster; every task sends ``most`` boxes and its counts
    to the driver.
    """

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(4)

        def parts() -> Iterator[np.ndarray]:
            for batch in batches:
                rows = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], axis=1)
                rows, places = rows[:, :4], rows[:, 4]
                known = ~np.isnan(rows).any(axis=1)
                rows = rows[known]
                wide = np.floor(rows[:, 2:] / cell) - np.floor(rows[:, :2] / cell) + 1
                counts[:] += [(~known).sum(), len(rows), wide.prod(axis=1).sum(), np.where(np.isnan(places), np.inf, places).sum()]
                yield rows

        boxes = reduce_boxes(parts(), most)
        rows = np.zeros((len(boxes) + 1, 8))
        # the last row has the counts and no box
        rows[:-1, :4], rows[-1, :4], rows[-1, 4:] = boxes, np.nan, counts
        yield pa.RecordBatch.from_arrays([pa.array(rows[:, k]) for k in range(8)], names=names)

    names = [*BOUNDS, "missing", "rasters", "cells", "places"]
    places = F.col("n_rows").cast("double") * F.col("n_cols") if {"n_rows", "n_cols"} <= set(bounds.columns) else F.lit(None).cast("double")
    found = bounds.select(*BOUNDS, places.alias("places")).mapInArrow(task, ", ".join(f"{n} double" for n in names)).collect()
    rows = np.array([tuple(r) for r in found]).reshape(-1, 8)
    missing, *counts = rows[:, 4:].sum(axis=0).tolist()
    if missing:
        raise ValueError("a raster has no extent: its projection is not supported")
    boxes = reduce_boxes([rows[~np.isnan(rows[:, 0]), :4]], most)
    return Survey([tuple(map(float, b)) for b in boxes], *counts)


def packed_extents(bounds: DataFrame, most: int = 32) -> list[tuple[float, float, float, float]]:
    """At most ``most`` boxes that cover every extent, see :func:`survey`."""
    return survey(bounds, most).boxes
