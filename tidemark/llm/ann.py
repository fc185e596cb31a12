"""Nearest neighbours by inner product: a hierarchical navigable small-world graph per shard.

Rows are dealt to shards of about ``SHARD`` vectors by the band of their norm, which a factor of two
spans, and by a hash of their id, so a vector that very many rows share is spread too; inside a shard
equal vectors are one node with many ids. Every node gets one more coordinate that makes all norms of
the shard equal, which turns the largest inner product into the nearest point; since norms of a shard
differ little, that coordinate never drowns the others, whatever the norms of the table. A graph is kept as flat neighbour arrays, one row of a
table per shard. Queries meet every shard in blocks, each shard answers with its best ``k``, and
the answers are merged. Scores are inner products of the original vectors in double precision. The
order is that of the same products scaled by powers of two, which is the order of the scores wherever
these do not overflow or vanish; there the order stays true although the scores are equal.

Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do
rows without id. Only vectors of one length are compared. An id given twice counts once, with
its best score. A shard of no more nodes than a search keeps is scanned. Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import pick, seeded, stored

SHARD = 8192
BLOCK = 2048
# EF: nodes a search keeps in every shard, however many shards the table has
DEGREE, EF_BUILD, EF = 16, 64, 160
EMPTY = -1
# nodes a search expands at once, nodes that look for their neighbours at once
WIDE, ROWS = 32, 512


class Graph:
    """Flat layers: ``links[layer]`` is nodes by slots; upper layers list their nodes in ``rows``."""

    def __init__(self, points: np.ndarray, links: list[np.ndarray], rows: list[np.ndarray], entry: int):
        self.points, self.links, self.rows, self.entry = points, links, rows, entry
        self.seen, self.stamp = np.zeros(len(points), np.int32), 0
        self.first = np.zeros(len(points), np.int32)

    def near(self, layer: int, nodes: np.ndarray) -> np.ndarray:
        """Neighbours of the nodes that this search has not seen, each once."""
        own = self.links[layer][nodes if layer == 0 else self.rows[layer][nodes]].ravel()
        own = own[own != EMPTY]
        own = own[self.seen[own] != self.stamp]
        place = np.arange(len(own), dtype=np.int32)
        self.first[own] = place
        own = own[self.first[own] == place]
        self.seen[own] = self.stamp
        return own

    def search(self, q: np.ndarray, start: int, ef: int, layer: int) -> np.ndarray:
        """Best ``ef`` nodes reached from ``start``, best first: ends when all of them are expanded."""
        self.stamp += 1
        self.seen[start] = self.stamp
        nodes, close, todo = np.array([start]), self.points[[start]] @ q, np.ones(1, bool)
        while True:
            open_ = np.flatnonzero(todo)
            if not len(open_):
                return nodes[np.lexsort((nodes, -close))]
            if len(open_) > WIDE:
                open_ = open_[np.argpartition(-close[open_], WIDE - 1)[:WIDE]]
            todo[open_] = False
            near = self.near(layer, nodes[open_])
            reached = self.points[near] @ q
            if len(nodes) >= ef:
                good = reached > close.min()
                near, reached = near[good], reached[good]
            if not len(near):
                continue
            nodes, close = np.concatenate([nodes, near]), np.concatenate([close, reached])
            todo = np.concatenate([todo, np.ones(len(near), bool)])
            if len(nodes) > ef:
                best = np.argpartition(-close, ef - 1)[:ef]
                nodes, close, todo = nodes[best], close[best], todo[best]

    def descend(self, q: np.ndarray, to: int) -> int:
        at = self.entry
        for layer in range(len(self.links) - 1, to, -1):
            at = int(self.search(q, at, 1, layer)[0])
        return at

    def query(self, q: np.ndarray, ef: int) -> np.ndarray:
        if len(self.points) <= ef:
            return np.arange(len(self.points))
        return self.search(q, self.descend(q, 0), ef, 0)


def spread(points: np.ndarray, nodes: np.ndarray, close: np.ndarray, size: int) -> np.ndarray:
    """Neighbours that are nearer to the node than to each other, filled up with the nearest."""
    order = np.argsort(-close, kind="stable")
    nodes, close = nodes[order], close[order]
    among = points[nodes] @ points[nodes].T
    most, kept, rest = np.full(len(nodes), -np.inf), [], []
    for i in range(len(nodes)):
        if len(kept) == size:
            break
        if close[i] > most[i]:
            kept.append(i)
            np.maximum(most, among[i], out=most)
        else:
            rest.append(i)
    return nodes[kept + rest[: size - len(kept)]]


def nearest_before(points: np.ndarray, members: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each member but the first, its nearest ``EF_BUILD`` among those before it, and how near they are.

    Products of a block of nodes with all before it: exact, and a small part of a search for each node.
    """
    for a in range(0, len(members), ROWS):
        rows = np.arange(a, min(a + ROWS, len(members)))
        close = points[members[rows]] @ points[members[: rows[-1] + 1]].T
        close[np.arange(close.shape[1])[None] >= rows[:, None]] = -np.inf
        held = min(EF_BUILD, close.shape[1])
        best = np.argpartition(-close, held - 1, axis=1)[:, :held]
        near = np.take_along_axis(close, best, axis=1)
        for i, row in enumerate(rows.tolist()):
            if row:
                known = near[i] > -np.inf
                yield row, members[best[i][known]], near[i][known]


def build(points: np.ndarray, seed: int) -> Graph:
    """Links the points one by one, layer by layer, to their nearest before them. Slots are twice the
    degree; a full node is thinned to it."""
    n = len(points)
    level = np.minimum((-np.log(np.random.default_rng(seed).random(n) + 1e-12) / np.log(DEGREE)).astype(int), 8)
    links, rows = [], []
    for layer in range(int(level.max(initial=0)) + 1):
        members = np.flatnonzero(level >= layer)
        place = np.full(n, EMPTY)
        place[members] = np.arange(len(members))
        degree = DEGREE * (2 if layer == 0 else 1)
        table, count = np.full((len(members), 2 * degree), EMPTY, np.int32), [0] * len(members)
        for r, nodes, close in nearest_before(points, members):
            chosen = spread(points, nodes, close, DEGREE)
            table[r, : len(chosen)], count[r] = chosen, len(chosen)
            node = members[r]
            for other, o in zip(chosen.tolist(), place[chosen].tolist(), strict=True):
                if count[o] == 2 * degree:
                    near = np.append(table[o], node)
                    keep = spread(points, near, points[near] @ points[other], degree)
                    table[o] = EMPTY
                    table[o, : len(keep)], count[o] = keep, len(keep)
                else:
                    table[o, count[o]] = node
                    count[o] += 1
        links.append(table)
        rows.append(place)
    # the first of the highest layer
    return Graph(points, links, rows, int(np.argmax(level)) if n else 0)


# --- shards ------------------------------------------------------------------------
GRAPH = "dim int, band int, shard int, ids binary, owners binary, vectors binary, links binary, layers binary, entry int, scale double"


def level(vectors: np.ndarray, band: int, scale: float | None = None) -> tuple[np.ndarray, float]:
    """Vectors of one band with one more coordinate, all of length one, and the norm they were divided by."""
    near_one = np.ldexp(vectors, -band)
    norm = np.linalg.norm(near_one, axis=1)
    scale = float(norm.max()) if scale is None else scale
    return np.hstack([near_one / scale, np.sqrt(np.maximum(0, 1 - (norm / scale) ** 2))[:, None]]).astype(np.float32), scale


def build_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """One graph as flat arrays: ids by node, vectors, and per layer its members and links."""
    dim, band, shard = key
    vectors = np.array(rows["v"].tolist(), np.float64).reshape(-1, dim)
    distinct, owner = np.unique(vectors, axis=0, return_inverse=True)
    owner = owner.ravel()
    order = np.lexsort((rows["vec_id"], owner))
    place = np.stack([owner[order], rows["vec_id"].to_numpy()[order]])
    order = order[np.append(True, (place[:, 1:] != place[:, :-1]).any(0))]  # repeated rows once
    points, scale = level(distinct, band)
    shuffle = np.random.default_rng(seeded("order", dim, shard)).permutation(len(distinct))
    back = np.argsort(shuffle)
    graph = build(points[shuffle], seeded("levels", dim, shard))
    layers = [np.flatnonzero(place != EMPTY) for place in graph.rows[1:]]
    return pd.DataFrame(
        {
            "dim": [dim],
            "band": [band],
            "shard": [shard],
            "ids": [rows["vec_id"].to_numpy()[order].astype(np.int64).tobytes()],
            "owners": [back[owner[order]].astype(np.int32).tobytes()],
            "vectors": [distinct[shuffle].tobytes()],
            "links": [b"".join(x.tobytes() for x in graph.links)],
            "layers": [b"".join(np.append(x, EMPTY).astype(np.int32).tobytes() for x in layers)],
            "entry": [graph.entry],
            "scale": [scale],
        }
    )


def load_shard(row) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    """The graph, the original vectors, and ids with where each node's begin."""
    dim = int(row.dim)
    vectors = np.frombuffer(row.vectors, np.float64).reshape(-1, dim)
    points, _ = level(vectors, int(row.band), row.scale)
    flat, links, rows, at = np.frombuffer(row.links, np.int32), [], [np.arange(len(points))], 0
    marks = np.frombuffer(row.layers, np.int32)
    members = [np.arange(len(points)), *[x[x != EMPTY] for x in np.split(marks, np.flatnonzero(marks == EMPTY) + 1)[:-1]]]
    for layer, own in enumerate(members):
        width = 2 * DEGREE * (2 if layer == 0 else 1)
        links.append(flat[at : at + len(own) * width].reshape(-1, width))
        at += len(own) * width
        place = np.full(len(points), EMPTY)
        place[own] = np.arange(len(own))
        rows.append(place)
    ids, owners = np.frombuffer(row.ids, np.int64), np.frombuffer(row.owners, np.int32)
    order = np.argsort(owners, kind="stable")
    begin = np.searchsorted(owners[order], np.arange(len(points) + 1))
    return Graph(points, links, rows[1:], int(row.entry)), vectors, ids[order], begin


def search_shard(k: int, ef: int, top: int = 0):
    """``top``: the highest band of the table, to which products are scaled."""

    def search(key: tuple, graphs: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "near": [], "score": []}
        if len(graphs) and len(queries):
            graph, vectors, ids, begin = load_shard(graphs.iloc[0])
            band = int(graphs.iloc[0].band)
            for query_id, v in zip(queries["query_id"], queries["v"], strict=True):
                q = np.asarray(v, np.float64)
                unit = np.ldexp(q, -int(np.frexp(np.abs(q).max())[1]))
                nodes = graph.query(np.append(unit / np.linalg.norm(unit), 0).astype(np.float32), max(ef, k + 1))
                with np.errstate(over="ignore", invalid="ignore"):
                    score = (vectors[nodes] * q).sum(1)
                near = np.ldexp((np.ldexp(vectors[nodes], -band) * unit).sum(1), band - top)
                # of one node's ids only the k + 1 smallest can be among the answers
                size = np.minimum(begin[nodes + 1] - begin[nodes], k + 1)
                at = np.repeat(begin[nodes] - np.cumsum(size) + size, size) + np.arange(size.sum())
                found, score, near = ids[at], np.repeat(score, size), np.repeat(near, size)
                other = found != query_id
                score, near, found = score[other], near[other], found[other]
                best = np.lexsort((found, -near))
                best = best[np.sort(np.unique(found[best], return_index=True)[1])[:k]]
                out["query_id"].append(np.full(len(best), query_id))
                out["vec_id"].append(found[best])
                out["near"].append(near[best])
                out["score"].append(score[best])
        return pd.DataFrame({c: np.concatenate(x) if x else np.zeros(0, np.float64 if c in ("near", "score") else np.int64) for c, x in out.items()})

    return search


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, v, dim, band)`` of the rows that take part. ``band``: the nearest power of two of the norm."""
    rows = pick(vectors, vec_id="vec_id", v="embedding").where("vec_id is not null and v is not null").withColumn("v", F.col("v").cast("array<double>"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite & F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v"))
    most = F.array_max(F.transform("v", F.abs))
    squares = F.aggregate("v", F.lit(0.0), lambda total, x: total + (x / F.col("most")) * (x / F.col("most")))
    norm = F.log2("most") + F.log2(squares) / 2
    return rows.withColumn("most", most).withColumn("band", F.round(norm).cast("int")).drop("most")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, ef: int = EF, shard_rows: int = SHARD) -> DataFrame:
    """``(query_id, rank, vec_id, score)``. Both tables have vec_id and embedding."""
    rows, asked = usable(vectors), usable(queries)
    # doubles have some two thousand bands, most tables a few
    held = {r.band: 1 + r.n // shard_rows for r in rows.groupBy("band").agg(F.count("*").alias("n")).collect()} or {0: 1}
    blocks = 1 + queries.count() // BLOCK
    bands = F.array(*[F.struct(F.lit(b).alias("band"), F.lit(n).alias("shards")) for b, n in sorted(held.items())])
    shards = F.element_at(F.map_from_entries(bands), F.col("band"))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), shards).cast("int"))
    graphs = stored(rows.groupBy("dim", "band", "shard").applyInPandas(build_shard, GRAPH))
    held_graphs = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = asked.select("dim", F.col("vec_id").alias("query_id"), "v", F.pmod(F.xxhash64(F.lit(7), F.col("vec_id")), F.lit(blocks)).cast("int").alias("block"))
    asked = asked.select("*", F.inline(bands)).select("dim", "query_id", "v", "block", "band", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    key = ["dim", "band", "shard", "block"]
    search = search_shard(k, ef, max(held))
    found = held_graphs.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(search, "query_id long, vec_id long, near double, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max(F.struct("near", "score")).alias("best")).select("query_id", "vec_id", "best.*")
    order = Window.partitionBy("query_id").orderBy(F.desc("near"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
