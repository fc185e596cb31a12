"""Near-duplicate documents: HyperMinHash registers, banded; links confirmed on full sets.

A document's set holds the hashes (64-bit) of its distinct word shingles; A-Z are lower-cased.
Sets are put into ``BANDS * ROWS`` buckets and each bucket keeps the least hash as a register:
its number of leading zeros and ``MANTISSA`` bits more. An empty bucket borrows from a bucket
named by a fixed sequence of probes, then from the first filled one in a fixed order of its own,
so small sets band like large ones. At a similarity of 0.8
two sets miss each other in all bands with probability below 2e-7.

1. Equal sets become one class; the smallest ``doc_id`` stands for it.
2. Classes that agree on a band share a block. Each first meets the hub (smallest id) that it
   shares most blocks with. Blocks that still hold several components then look for links
   between these: blocks of up to ``CROWDED`` members by pairs, larger ones through what
   each member does not share with a reference text, see ``crowded_links``. What is left out
   are pairs already connected or provably unlinked; no block is expanded into all its pairs.
3. A pair is estimated from its registers, corrected for chance collisions, and dropped when
   the estimate is over six standard errors below the threshold; pairs with a set of under
   ``FEW`` shingles are not estimated. The rest is decided on full sets, in integers:
   ``100 * intersection >= percent * union``.
4. Components by star contraction, in tables.

Null text and text without words have an empty set, which links with nothing. Rows without
``doc_id`` are left out. Repeated rows give repeated results; texts under one id count as linked.
Extra columns are ignored. Registers and candidates are written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import mix, pick, powers, raw_texts, run_hash, slices, stored, word_table
from tidemark.llm.components import components

BANDS, ROWS = 40, 5
REGISTERS = BANDS * ROWS
MANTISSA = 10
PERCENT = 80
CROWDED = 8
FULL = np.uint64(2**64 - 1)
PROBES = np.random.default_rng(99).integers(0, REGISTERS, (64, REGISTERS))
# for each bucket an order of all buckets, for what the probes leave empty
ORDER = np.random.default_rng(98).permuted(np.tile(np.arange(REGISTERS), (REGISTERS, 1)), axis=1)
# sets too small for the estimate's error bound
FEW = 64


# --- sets and registers ------------------------------------------------------------
def shingle_sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle."""
    _, _, words, first, _ = word_table([t.lower() for t in texts])
    runs = run_hash(words, size)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= size:
            yield np.unique(runs[a : b - size + 1])
        elif b > a:
            yield run_hash(words[a:b], b - a) ^ powers(np.uint64(0x9FB21C651E98DF25), size)[b - a :][:1]
        else:
            yield np.zeros(0, np.uint64)


def leading_zeros(x: np.ndarray) -> np.ndarray:
    """Of 64-bit values; exact where the float logarithm is not."""
    x = x.copy()
    out = np.zeros(x.shape, np.uint64)
    for step in (32, 16, 8, 4, 2, 1):
        clear = x < (np.uint64(1) << np.uint64(64 - step))
        out[clear] += np.uint64(step)
        x[clear] <<= np.uint64(step)
    return out


def registers(values: np.ndarray) -> np.ndarray:
    """Registers of a non-empty set; empty buckets borrow."""
    h = mix(values ^ np.uint64(0xA0761D6478BD642F))
    bucket = ((h >> np.uint64(40)) % np.uint64(REGISTERS)).astype(np.int64)
    rest = mix(h)
    least = np.full(REGISTERS, FULL)
    np.minimum.at(least, bucket, rest)
    full = np.zeros(REGISTERS, bool)
    full[bucket] = True
    zeros = leading_zeros(least)
    tail = (least << np.minimum(zeros, np.uint64(62)) << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    out = ((zeros << np.uint64(MANTISSA)) | tail).astype(np.uint16)
    empty = np.flatnonzero(~full)
    for probe in PROBES:
        if not len(empty):
            return out
        source = probe[empty]
        out[empty] = np.where(full[source], out[source], out[empty])
        empty = empty[~full[source]]
    filled = np.flatnonzero(full)
    out[empty] = out[filled[ORDER[empty][:, filled].argmin(1)]]
    return out


def sketch_task(size: int):
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                n, hi, lo, sig = [], [], [], []
                for values in shingle_sets(raw_texts(piece.column(1)), size):
                    n.append(len(values))
                    key = xxhash.xxh3_128_intdigest(values.tobytes())
                    hi.append((key >> 64) - 2**63 if len(values) else None)
                    lo.append((key & (2**64 - 1)) - 2**63 if len(values) else None)
                    sig.append(registers(values).tobytes() if len(values) else None)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(sig, pa.binary())],
                    names=["doc_id", "n_shingles", "k1", "k2", "sig"],
                )

    return task


def band_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seeds = mix(np.arange(1, BANDS + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for batch in batches:
        for lo in range(0, batch.num_rows, 2000):
            piece = batch.slice(lo, 2000)
            sig = np.frombuffer(b"".join(piece.column(1).to_pylist()), np.uint16).reshape(-1, BANDS, ROWS).astype(np.uint64)
            key = np.broadcast_to(seeds, sig.shape[:2])
            for j in range(ROWS):
                key = mix(key ^ sig[:, :, j])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(piece.column(0).to_numpy(zero_copy_only=False), BANDS)), pa.array(key.ravel().view(np.int64))], names=["rep", "band"]
            )


# --- pairs -------------------------------------------------------------------------
def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarity of sets of ``n`` and ``m`` from their registers, without chance collisions.

    Registers of unlike minima agree when both fall into one cell; a cell at ``x`` is about
    ``0.7213 * x / 2**MANTISSA`` wide and the minima are exponential in the sets' sizes.
    """
    same = (a == b).mean(1)
    chance = 0.7213 / 2**MANTISSA * (n * m) / (n + m) ** 2
    return (same - chance) / (1 - chance)


def estimate_task(percent: int):
    t = percent / 100
    cut = t - 6 * np.sqrt(t * (1 - t) / REGISTERS)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS) for i in (2, 3))
            n, m = (batch.column(i).to_numpy().astype(float) for i in (4, 5))
            fits = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
            keep = fits & ((np.minimum(n, m) < FEW) | (estimate(a, b, n, m) >= cut))
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep)) for i in (0, 1)], names=["u", "v"])

    return task


def verify_task(size: int, percent: int):
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                piece = batch.slice(lo, 200)
                texts = [piece.column(i).to_pylist() for i in (2, 3)]
                distinct = list(dict.fromkeys([*texts[0], *texts[1]]))
                sets = dict(zip(distinct, shingle_sets([t.encode() for t in distinct], size), strict=True))
                keep = []
                for x, y in zip(*texts, strict=True):
                    common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                    keep.append(100 * common >= percent * (len(sets[x]) + len(sets[y]) - common))
                yield pa.RecordBatch.from_arrays([piece.column(i).filter(pa.array(keep)) for i in (0, 1)], names=["u", "v"])

    return task


def side(df: DataFrame, name: str, *columns: str) -> DataFrame:
    return df.select(F.col("rep").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])


def links_of(pairs: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` that are links."""
    likely = (
        pairs.join(side(classes, "u", "sig", "n"), "u").join(side(classes, "v", "sig", "n"), "v")
        .select("u", "v", "sig_u", "sig_v", "n_u", "n_v").mapInArrow(estimate_task(percent), "u long, v long")
    )
    return (
        likely.join(side(texts, "u", "text"), "u").join(side(texts, "v", "text"), "v")
        .select("u", "v", "text_u", "text_v").mapInArrow(verify_task(size, percent), "u long, v long")
    )


# --- crowded blocks ----------------------------------------------------------------
def difference_task(size: int):
    """Size of a set, and what it and a reference's set do not share."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                piece = batch.slice(lo, 200)
                texts = [piece.column(i).to_pylist() for i in (2, 3)]
                distinct = list(dict.fromkeys([*texts[0], *texts[1]]))
                sets = dict(zip(distinct, shingle_sets([t.encode() for t in distinct], size), strict=True))
                apart = [np.setxor1d(sets[x], sets[y], assume_unique=True).view(np.int64) for x, y in zip(*texts, strict=True)]
                n, m = ([len(sets[x]) for x in side] for side in texts)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.array(m, pa.int64()), pa.array(n, pa.int64()), pa.array(apart, pa.list_(pa.int64()))],
                    names=["ref", "rep", "n", "n_ref", "apart"],
                )

    return task


def crowded_links(places: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between members of one crowded block in different components, without its pairs.

    ``places`` has ref, rep and c: members of blocks, a reference for each block (any text will
    do) and the member's component. With D as what a set and the reference's do not share, two
    sets differ in ``|Du| + |Dv| - 2 |Du & Dv|`` shingles and are linked when that is at most
    ``(n_u + n_v) * (100 - percent) / (100 + percent)``. So members close to the reference are
    linked with it, and any other must share a stated number of *differences* with its
    partner: an inverted list over differences, rarest first, finds all partners by prefix, and the
    differences that a whole group shares are not looked up.
    """
    joined = places.join(side(texts, "ref", "text"), "ref").join(side(texts, "rep", "text"), "rep")
    shape = "ref long, rep long, n long, n_ref long, apart array<long>"
    apart = joined.where("ref <> rep").select("ref", "rep", "text_ref", "text_rep").distinct().mapInArrow(difference_task(size), shape)
    apart = stored(apart.join(places.select("ref", "rep", "c").distinct(), ["ref", "rep"]).withColumn("d", F.size("apart")))
    near_ref = F.col("d") * (100 + percent) <= (F.col("n") + F.col("n_ref")) * (100 - percent)
    linked = apart.where(near_ref).select(F.col("ref").alias("u"), F.col("rep").alias("v"))

    share = (100 - percent) / (100 + percent)
    entries = apart.withColumn("far", ~near_ref).select("ref", "rep", "c", "n", "d", "far", F.explode("apart").alias("e"))
    common = entries.groupBy("ref", "e").count()
    placed = Window.partitionBy("ref", "rep").orderBy("count", "e")
    entries = entries.join(common, ["ref", "e"]).withColumn("at", F.row_number().over(placed)).drop("count")
    # least overlap that any partner can do with: over half of what is left of d for either
    # side of a far member, all but the allowed difference for a far member itself
    least = F.greatest(F.lit(1.0), F.when(F.col("far"), F.col("d") - share * F.col("n") * (1 + 100 / percent)).otherwise(F.col("d") * (1 - share) / 2))
    entries = entries.where(F.col("at") <= F.col("d") - F.ceil(least - 1e-6) + 1)
    one, two = (entries.select("ref", "e", *[F.col(x).alias(f"{x}_{y}") for x in ("rep", "c", "n", "d", "far", "at")]) for y in "uv")
    need = F.ceil((F.col("d_u") + F.col("d_v") - share * (F.col("n_u") + F.col("n_v"))) / 2 - 1e-6)
    fits = (F.col("at_u") <= F.col("d_u") - need + 1) & (F.col("at_v") <= F.col("d_v") - need + 1)
    once = ~F.col("far_v") | (F.col("rep_u") < F.col("rep_v"))
    pairs = one.where("far_u").join(two, ["ref", "e"]).where((F.col("c_u") != F.col("c_v")) & once & fits).select("ref", "rep_u", "rep_v").distinct()
    whole = lambda y: apart.select("ref", *[F.col(x).alias(f"{x}_{y}") for x in ("rep", "n", "d", "apart")])
    pairs = pairs.join(whole("u"), ["ref", "rep_u"]).join(whole("v"), ["ref", "rep_v"])
    unlike = F.col("d_u") + F.col("d_v") - 2 * F.size(F.array_intersect("apart_u", "apart_v"))
    pairs = pairs.where(unlike * (100 + percent) <= (F.col("n_u") + F.col("n_v")) * (100 - percent))
    return linked.unionByName(pairs.select(F.col("rep_u").alias("u"), F.col("rep_v").alias("v")))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, class_id, component_id)`` for every row with an id.

    ``class_id`` is the smallest id with an equal set, ``component_id`` the smallest reachable.
    """
    docs = pick(docs, doc_id="doc_id", text="text").where("doc_id is not null")
    sketches = stored(docs.mapInArrow(sketch_task(size), "doc_id long, n_shingles long, k1 long, k2 long, sig binary"))
    classes = stored(
        sketches.where("sig is not null").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
    )
    bands = classes.select("rep", "sig").mapInArrow(band_task, "rep long, band long")
    blocks = bands.groupBy("band").agg(F.min("rep").alias("hub"), F.count("*").alias("members")).where("members > 1").select("band", "hub")
    members = stored(bands.join(blocks, "band").select("band", "rep", "hub"))
    texts = stored(docs.join(members.select(F.col("rep").alias("doc_id")).distinct(), "doc_id").select(F.col("doc_id").alias("rep"), F.coalesce("text", F.lit("")).alias("text")))

    hubs = members.where("rep <> hub").groupBy("rep", "hub").agg(F.count("*").alias("shared"))
    best = hubs.groupBy("rep").agg(F.min(F.struct(-F.col("shared"), "hub")).alias("b"))
    best = best.select(F.col("b.hub").alias("u"), F.col("rep").alias("v"))
    check = lambda pairs: links_of(pairs, classes, texts, size, percent)
    links = stored(check(best))
    comps = stored(components(links))

    placed = members.join(comps.select(F.col("node").alias("rep"), "component"), "rep", "left").select("band", "rep", F.coalesce("component", "rep").alias("c"))
    mixed = placed.groupBy("band").agg(F.min("c").alias("ref"), F.max("c").alias("other"), F.count("*").alias("size")).where("ref <> other").drop("other")
    placed = stored(placed.join(mixed, "band"))
    small = placed.where(F.col("size") <= CROWDED)
    left, right = (small.select("band", F.col("rep").alias(x), F.col("c").alias(f"c_{x}")) for x in "uv")
    rest = left.join(right, "band").where("u < v and c_u <> c_v").select("u", "v").distinct()
    crowded = placed.where(F.col("size") > CROWDED).select("ref", "rep", "c").distinct()
    found = stored(check(rest).unionByName(crowded_links(crowded, texts, size, percent)))
    if not found.isEmpty():
        comps = stored(components(links.unionByName(found)))

    key = ["k1", "k2"]
    named = classes.join(comps, classes["rep"] == comps["node"], "left").select(*key, "rep", F.coalesce("component", "rep").alias("component"))
    return sketches.join(named, key, "left").select(
        "doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("class_id"), F.coalesce("component", "doc_id").alias("component_id")
    )
