"""Benchmark decontamination by greedy string tiling.

Words of A-Z lower-cased. A seed is ``tile`` consecutive words of a test item (the whole item
where it is shorter). Documents that share a seed with an item are tiled against it: the longest
run of words that is unmarked on both sides is marked, again and again, until none of ``tile``
words is left; so passages in another order count in full. Runs are found by Karp-Rabin
fingerprints (64-bit) of ``tile`` words and joined along diagonals; where words repeat so much that
their pairs would be many more than the words, by fingerprints of growing and shrinking length
instead, in memory of the order of the two texts and with the same tiles. An item leaks into a
document when its tiles cover ``coverage`` of its words.

The distinct test items go to the tasks in blocks of about ``BLOCK_WORDS`` words, or of one longer item, so what
is broadcast has a bound, and documents are read once per block. Documents are neither shuffled nor
cut; a very long one is tiled whole.

Null text or item text has no words and matches nothing. Items given more than once are tiled once and reported
as often as they are given.
Rows without ``doc_id`` are reported with a null id. Empty tables give no leak. Extra columns
are ignored by ``leaks`` and kept by ``decontaminate``.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_STEP, WORD_STEP_INVERSE, mix, pick, powers, raw_texts, run_hash, slices, word_table

TILE = 5
COVERAGE = 0.5
BLOCK_WORDS = 1_000_000
FLAGS = 1 << 22
# equal windows for each word, above which they are not listed
PAIRS_A_WORD = 16


def maximal_runs(item: np.ndarray, doc: np.ndarray, tile: int) -> list[tuple[int, int, int]]:
    """Longest common runs ``(length, item start, document start)`` of ``tile`` words or more."""
    own, other = run_hash(item, tile), run_hash(doc, tile)
    order = np.argsort(own, kind="stable")
    lo, hi = (np.searchsorted(own[order], other, side) for side in ("left", "right"))
    at = np.flatnonzero(hi > lo)
    n = (hi - lo)[at]
    j = np.repeat(at, n)
    i = order[np.repeat(lo[at], n) + np.arange(len(j)) - np.repeat(np.cumsum(n) - n, n)]
    line = np.lexsort((i, j - i))
    i, j = i[line], j[line]
    if not len(i):
        return []
    head = np.flatnonzero(np.concatenate([[True], (i[1:] != i[:-1] + 1) | (j[1:] != j[:-1] + 1)]))
    size = np.diff(np.append(head, len(i))) + tile - 1
    return list(zip(size.tolist(), i[head].tolist(), j[head].tolist(), strict=True))


class Windows:
    """Fingerprints of all windows of any length over one text, and which words are taken."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.forth = powers(WORD_STEP, n + 1)
        self.sums = np.append(np.uint64(0), np.cumsum(words * powers(WORD_STEP_INVERSE, n)[:n], dtype=np.uint64))
        self.taken = np.zeros(n, bool)

    def free(self, length: int) -> np.ndarray:
        """Starts of the windows without a taken word."""
        before = np.append(0, np.cumsum(self.taken))
        return np.flatnonzero(before[length:] == before[: len(before) - length])

    def prints(self, starts: np.ndarray, length: int) -> np.ndarray:
        return mix((self.sums[starts + length] - self.sums[starts]) * self.forth[starts])


def common_windows(a: Windows, b: Windows, length: int) -> tuple[np.ndarray, ...]:
    """Free windows of ``a`` that ``b`` has free too: their starts and prints, and all of b's with prints, sorted."""
    i, j = a.free(length), b.free(length)
    own, other = a.prints(i, length), b.prints(j, length)
    distinct = np.unique(own)
    if not len(distinct) or not len(j):
        return i[:0], own[:0], j[:0], other[:0]
    at = np.minimum(np.searchsorted(distinct, other), len(distinct) - 1)
    hit = distinct[at] == other
    j, other = j[hit], other[hit]
    order = np.argsort(other, kind="stable")
    keep = np.isin(own, other)
    return i[keep], own[keep], j[order], other[order]


def tiles_in_repeats(item: np.ndarray, doc: np.ndarray, tile: int) -> list[tuple[int, int, int]]:
    """The tiles of :func:`tiles` without listing pairs of equal windows.

    The longest free common run is found by halving, since each run holds shorter ones. All tiles of
    that length are taken in order of the item; a window once without a free partner stays so.
    """
    a, b, out, most = Windows(item), Windows(doc), [], min(len(item), len(doc))
    while most >= tile and len(common_windows(a, b, tile)[0]):
        low, high = tile, most
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if len(common_windows(a, b, middle)[0]) else (low, middle - 1)
        starts, own, places, other = common_windows(a, b, low)
        first, last = np.searchsorted(other, own, "left"), np.searchsorted(other, own, "right")
        passed: dict[int, int] = {}  # of each print: places of the document that are used up
        reach = 0
        for i, f, e in zip(starts.tolist(), first.tolist(), last.tolist(), strict=True):
            if i < reach:
                continue
            k = passed.get(f, f)
            while k < e and b.taken[places[k] : places[k] + low].any():
                k += 1
            passed[f] = k
            if k < e:
                j = int(places[k])
                a.taken[i : i + low] = b.taken[j : j + low] = True
                out.append((low, i, j))
                reach = i + low
        most = low - 1
    return out


def pair_count(item: np.ndarray, doc: np.ndarray, tile: int) -> int:
    """How many pairs of equal windows :func:`maximal_runs` would list."""
    own, other = np.sort(run_hash(item, tile)), run_hash(doc, tile)
    return int((np.searchsorted(own, other, "right") - np.searchsorted(own, other, "left")).sum())


def tiles(item: np.ndarray, doc: np.ndarray, tile: int) -> list[tuple[int, int, int]]:
    """Greedy tiling; ties go to the earlier place in the item, then in the document."""
    if pair_count(item, doc, tile) > PAIRS_A_WORD * (len(item) + len(doc)):
        return tiles_in_repeats(item, doc, tile)
    queue = [(-n, i, j) for n, i, j in maximal_runs(item, doc, tile)]
    heapq.heapify(queue)
    taken_item, taken_doc, out = np.zeros(len(item), bool), np.zeros(len(doc), bool), []
    while queue:
        n, i, j = heapq.heappop(queue)
        free = ~(taken_item[i : i - n] | taken_doc[j : j - n])
        if free.all():
            taken_item[i : i - n] = taken_doc[j : j - n] = True
            out.append((-n, i, j))
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[0], free.astype(np.int8), [0]])))
        for a, b in edge.reshape(-1, 2).tolist():
            if b - a >= tile:
                heapq.heappush(queue, (a - b, i + a, j + a))
    return out


class Items:
    """A block of test items, how often each is given, and their seeds."""

    def __init__(self, rows: list[tuple[int | None, str | None, int]], tile: int):
        texts = [(t or "").encode().lower() for _, t, _ in rows]
        _, _, words, first, _ = word_table(texts) if rows else (None, None, np.zeros(0, np.uint64), np.zeros(1, int), None)
        self.ids, self.given = [r[0] for r in rows], [r[2] for r in rows]
        self.words = [words[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        self.tile = [min(tile, len(w)) for w in self.words]
        seeds = defaultdict(list)
        for k, (w, n) in enumerate(zip(self.words, self.tile, strict=True)):
            if n:
                h = run_hash(w, n)
                seeds[n].append((h, np.full(len(h), k)))
        self.seeds = {}
        for n, parts in seeds.items():
            h, k = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(h, kind="stable")
            flags = np.zeros(FLAGS, bool)
            flags[h % np.uint64(FLAGS)] = True
            self.seeds[n] = h[order], k[order], flags

    def pairs(self, words: np.ndarray, first: np.ndarray) -> set[tuple[int, int]]:
        """Texts and items that share a seed."""
        found = set()
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        for n, (seeds, item, flags) in self.seeds.items():
            h = run_hash(words, n)
            at = np.flatnonzero(flags[h % np.uint64(FLAGS)])
            at = at[text[at] == text[at + n - 1]]
            lo, hi = np.searchsorted(seeds, h[at], "left"), np.searchsorted(seeds, h[at], "right")
            for p, a, b in zip(text[at].tolist(), lo.tolist(), hi.tolist(), strict=True):
                found.update((p, k) for k in item[a:b].tolist())
        return found

    def leaks(self, texts: list[bytes], coverage: float) -> list[tuple[int, int, int, int, float]]:
        """Text, item, covered words, tiles and coverage of each leak."""
        _, _, words, first, _ = word_table([t.lower() for t in texts])
        out = []
        for p, k in sorted(self.pairs(words, first)):
            found = tiles(self.words[k], words[first[p] : first[p + 1]], self.tile[k])
            covered = sum(n for n, _, _ in found)
            if covered >= coverage * len(self.words[k]):
                out.append((p, k, covered, len(found), covered / len(self.words[k])))
        return out


def blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[int | None, str | None, int]]]:
    """The distinct test items and how often each is given, in parts of about ``block_words`` words, one part at a time."""
    items = pick(benchmark, item_id="item_id", text="text").groupBy("item_id", "text").agg(F.count("*").alias("given"))
    total = items.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    count = 1 + total // (block_words * 6)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for k in range(count):
        yield [tuple(r) for r in items.where(part == k).orderBy("item_id", "text").collect()]


def leaks(docs: DataFrame, benchmark: DataFrame, tile: int = TILE, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(doc_id, item_id, covered, tiles, coverage)`` of every leaked item."""
    texts, sc = pick(docs, doc_id="doc_id", text="text"), docs.sparkSession.sparkContext
    shape, out = "doc_id long, item_id long, covered long, tiles long, coverage double, given long", None
    for rows in blocks(benchmark, block_words):
        shared = sc.broadcast(rows)

        def task(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = Items(shared.value, tile)
            for batch in batches:
                for piece in slices(batch):
                    ids, found = piece.column(0).to_pylist(), items.leaks(raw_texts(piece.column(1)), coverage)
                    columns = zip(*((ids[p], items.ids[k], *rest, items.given[k]) for p, k, *rest in found), strict=True) if found else [[]] * 6
                    kinds = [pa.int64()] * 4 + [pa.float64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "item_id", "covered", "tiles", "coverage", "given"])

        part = texts.mapInArrow(task, shape)
        out = part if out is None else out.unionByName(part)
    return out.withColumn("given", F.explode(F.sequence(F.lit(1), F.col("given")))).drop("given")


def decontaminate(docs: DataFrame, benchmark: DataFrame, tile: int = TILE, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents into which no item leaks, with all their columns."""
    sc, place = docs.sparkSession.sparkContext, docs.columns.index("text")
    for rows in blocks(benchmark, block_words):
        shared = sc.broadcast(rows)

        def task(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = Items(shared.value, tile)
            for batch in batches:
                for piece in slices(batch, place):
                    keep = np.ones(piece.num_rows, bool)
                    keep[[p for p, *_ in items.leaks(raw_texts(piece.column(place)), coverage)]] = False
                    yield piece.filter(pa.array(keep))

        docs = docs.mapInArrow(task, docs.schema)
    return docs
