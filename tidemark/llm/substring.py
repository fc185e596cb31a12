"""Removal of word runs that occur earlier in the corpus, by sharded compressed FM-indexes.

A window is ``window`` consecutive words of one document. A word goes when a window that
covers it also starts earlier: in a document of smaller id, or earlier in the same one.

1. Every window is routed by its anchor, the least hash among its short word runs, so equal
   windows carry equal anchors. Neighbouring windows with one anchor form a segment of at
   most ``2 * window - run`` words.
2. Equal segments are recognised by two 64-bit hashes; all but the first are wholly repeated.
   Tasks combine their own repeats first, so a passage found in every document reaches its
   shard once per task.
3. Different segments under one anchor may still share windows. Their words go to shards by
   anchor; under a crowded anchor they go window by window. Each shard builds an FM-index
   (wavelet matrix over the Burrows-Wheeler transform) of its segments and streams them
   through backward search; the interval of a window holds all its places, and its earliest
   place decides.

Work and shuffle grow with the text; no shard sees documents that share nothing with it.

Null text has no words. Rows without ``doc_id`` are left out. A row given twice is one
document and gives its result twice; texts under one id share their removed ranges. Extra
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import mix, pick, raw_texts, run_hash, slices, word_table

WINDOW = 20
RUN = 8
CROWDED = 256
BLOCK_ROWS = 2_000_000
RANGE = pa.schema([("doc_id", pa.int64()), ("s", pa.int32()), ("e", pa.int32())])


# --- FM-index ----------------------------------------------------------------------
class Bits:
    """A bit vector with rank: 64-bit words and the count before each."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts
        self.zeros = int(len(bits) - counts.sum())

    def rank(self, i: np.ndarray) -> np.ndarray:
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes ordered by their first ``depth`` symbols at least; doubling."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    span = 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[: max(n - span, 0)] = rank[span:] + 1
        key = rank * (n + 1) + ahead
        order = np.argsort(key, kind="stable")
        step = key[order]
        new = np.concatenate([[0], np.cumsum(step[1:] != step[:-1])])
        rank[order] = new
        span *= 2
        if span >= depth or new[-1] == n - 1:
            return order


class FMIndex:
    """Backward search over a wavelet matrix of the transform. Symbols are 0..size-1.

    ``depth`` bounds the patterns: suffixes are ordered up to twice that many symbols.
    """

    def __init__(self, symbols: np.ndarray, size: int, depth: int):
        self.places = suffix_order(symbols, 2 * depth)
        last = symbols[self.places - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=size))])
        self.n, self.levels = len(symbols), []
        for level in range(max(int(size - 1).bit_length(), 1) - 1, -1, -1):
            bit = (last >> level) & 1
            self.levels.append((level, Bits(bit.astype(bool))))
            last = np.concatenate([last[bit == 0], last[bit == 1]])
        self.origin = self._walk(np.arange(size), np.zeros(size, np.int64))

    def _walk(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, bits in self.levels:
            ones = bits.rank(i)
            i = np.where((c >> level) & 1, bits.zeros + ones, i - ones)
        return i

    def extend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with ``c`` put in front."""
        base = self.first[c] - self.origin[c]
        return base + self._walk(c, lo), base + self._walk(c, hi)

    def intervals(self, symbols: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = np.zeros(len(starts), np.int64), np.full(len(starts), self.n, np.int64)
        for j in range(length - 1, -1, -1):
            lo, hi = self.extend(symbols[starts + j], lo, hi)
        return lo, hi


# --- segments ----------------------------------------------------------------------
def least(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least of every ``width`` consecutive values and its leftmost place."""
    place, done = np.arange(len(values), dtype=np.int64), 1
    while done < width:
        s = min(done, width - done)
        m = len(values) - s
        right = values[s:] < values[:m]
        place, values = np.where(right, place[s:], place[:m]), np.where(right, values[s:], values[:m])
        done += s
    return values, place


def segments(words: np.ndarray, first: np.ndarray, window: int, run: int) -> tuple[np.ndarray, ...]:
    """Anchor, segment hash, text, first window and number of windows of each segment."""
    n = len(words) - window + 1
    if n <= 0:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 3
    anchor, place = least(run_hash(words, run), window - run + 1)
    whole = run_hash(words, window)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(text[:n] == text[window - 1 :])
    if not len(at):
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 3
    new = (place[at[1:]] != place[at[:-1]]) | (text[at[1:]] != text[at[:-1]])
    head = np.flatnonzero(np.concatenate([[True], new]))
    size = np.diff(np.append(head, len(at)))
    start = at[head]
    key = mix(whole[start] * np.uint64(3) + whole[start + size - 1] * np.uint64(5) + size.astype(np.uint64))
    return anchor[start], key, text[start], start - first[text[start]], size


def merged(doc: np.ndarray, s: np.ndarray, e: np.ndarray) -> pa.RecordBatch:
    """Ranges of one document that touch become one."""
    order = np.lexsort((s, doc))
    doc, s, e = doc[order], s[order], e[order]
    if len(doc):
        new = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        far = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(doc)))) * (int(e.max()) + 1)
        reach = np.maximum.accumulate(e + far)
        head = np.flatnonzero(np.concatenate([[True], (s + far)[1:] > reach[:-1]]))
        tail = np.append(head[1:], len(doc)) - 1
        doc, s, e = doc[head], s[head], (reach - far)[tail]
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(s, pa.int32()), pa.array(e, pa.int32())], schema=RANGE)


def combined(cols: list[tuple[np.ndarray, ...]]) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """Firsts and repeats of equal segments: anchor, key, document, first window, windows."""
    h, k, doc, a, size = (np.concatenate(x) for x in zip(*cols, strict=True))
    order = np.lexsort((a, doc, k, h))
    h, k, doc, a, size = h[order], k[order], doc[order], a[order], size[order]
    head = np.concatenate([[True], (h[1:] != h[:-1]) | (k[1:] != k[:-1])]) if len(h) else np.zeros(0, bool)
    # the same place given twice is no repeat
    place = np.repeat(np.flatnonzero(head), np.diff(np.append(np.flatnonzero(head), len(h)))) if len(h) else np.zeros(0, int)
    again = (doc != doc[place]) | (a != a[place])
    return tuple(x[head] for x in (h, k, doc, a, size)), tuple(x[again] for x in (doc, a, size))


def segment_task(window: int, run: int, repeats: bool):
    """Segments of the texts, each once per block; or the ranges repeated inside a block."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows = [], 0

        def out():
            (h, k, doc, a, size), (d2, a2, s2) = combined(block)
            if repeats:
                return merged(d2, a2, a2 + s2 + window - 1)
            return pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(k.view(np.int64)), pa.array(doc), pa.array(a.astype(np.int32)), pa.array(size.astype(np.int32))],
                names=["h", "k", "doc_id", "a", "size"],
            )

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            offset = 0
            for piece in slices(batch):
                _, _, words, first, _ = word_table(raw_texts(piece.column(1)))
                h, k, text, a, size = segments(words, first, window, run)
                block.append((h, k, ids[offset + text], a, size))
                offset += piece.num_rows
                rows += len(h)
                if rows >= BLOCK_ROWS:
                    yield out()
                    block, rows = [], 0
        if block:
            yield out()

    return task


def cut_task(window: int):
    """Words of the wanted segments.

    Segments under a crowded anchor go window by window, equal windows of a task once: the
    first with its words, the others without, which marks them as repeated.
    """

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crowd: dict[bytes, list[tuple[int, int]]] = {}
        held = 0
        rows: list[tuple[int, int, int, bytes | None]] = []

        def out():
            route, doc, a, words = zip(*rows, strict=True) if rows else ((),) * 4
            batch = pa.RecordBatch.from_arrays(
                [pa.array(route, pa.int64()), pa.array(doc, pa.int64()), pa.array(a, pa.int32()), pa.array(words, pa.binary())],
                names=["route", "doc_id", "a", "words"],
            )
            rows.clear()
            return batch

        def flush():
            for part, places in crowd.items():
                first = min(places)
                rows.append((hash_bytes(part), *first, part))
                rows.extend((0, *p, None) for p in set(places) if p != first)
            crowd.clear()

        for batch in batches:
            for doc, text, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = (text or "").encode().split()
                for w in wanted:
                    if not w["crowded"]:
                        part = b" ".join(words[w["a"] : w["a"] + w["size"] + window - 1])
                        rows.append((w["h"], doc, w["a"], part))
                        continue
                    for a in range(w["a"], w["a"] + w["size"]):
                        crowd.setdefault(b" ".join(words[a : a + window]), []).append((doc, a))
                        held += 1
                if held > BLOCK_ROWS // 10:
                    flush()
                    held = 0
                if len(rows) > 20_000:
                    yield out()
        flush()
        yield out()

    return task


def hash_bytes(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) - 2**63


def shard_task(window: int):
    """Builds the FM-index of a shard and streams its segments through it."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        docs, a = (table.column(c).to_numpy() for c in ("doc_id", "a"))
        code: dict[bytes, int] = {}
        symbols, sizes = [], []
        for segment in table.column("words").to_pylist():
            words = segment.split()
            symbols.extend([code.setdefault(w, len(code) + 1) for w in words])
            symbols.append(0)
            sizes.append(len(words))
        symbols, sizes = np.array(symbols, np.int64), np.array(sizes)
        begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        count = sizes - window + 1
        owner = np.repeat(np.arange(len(sizes)), count)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        starts = begin[owner] + inside
        doc, word = docs[owner], a[owner].astype(np.int64) + inside
        # windows in order of their places; equal places share a number
        order = np.lexsort((word, doc))
        new = np.concatenate([[0], np.cumsum((doc[order][1:] != doc[order][:-1]) | (word[order][1:] != word[order][:-1]))])
        number = np.empty(len(order), np.int64)
        number[order] = new
        index = FMIndex(symbols, len(code) + 1, window)
        lo, hi = index.intervals(symbols, starts, window)
        at_place = np.full(len(symbols), np.iinfo(np.int64).max)
        at_place[starts] = number
        in_order = np.append(at_place[index.places], np.iinfo(np.int64).max)
        distinct, one, back = np.unique(lo, return_index=True, return_inverse=True)
        earliest = np.minimum.reduceat(in_order, np.stack([distinct, hi[one]], 1).ravel())[::2]
        again = earliest[back] < number
        yield merged(doc[again], word[again], word[again] + window)

    return task


def keep_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words outside the removed ranges."""
    for batch in batches:
        kept, total, removed = [], [], []
        for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            words = (text or "").encode().split()
            n = len(words)
            if ranges:
                flag = np.zeros(n + 1, np.int64)
                for r in ranges:
                    flag[r["s"]] += 1
                    flag[min(r["e"], n)] -= 1
                words = [words[i] for i in np.flatnonzero(np.cumsum(flag[:n]) == 0)]
            kept.append(b" ".join(words).decode())
            total.append(n)
            removed.append(n - len(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept"],
        )


# --- operator ----------------------------------------------------------------------
def repeated_ranges(docs: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """``(doc_id, s, e)``: word ranges, end exclusive, that repeat an earlier window. Ranges may overlap."""
    texts = pick(docs, doc_id="doc_id", text="text").where("doc_id is not null")
    shape = "h long, k long, doc_id long, a int, size int"
    span = "doc_id long, s int, e int"
    inner = texts.mapInArrow(segment_task(window, run, True), span)

    groups = texts.mapInArrow(segment_task(window, run, False), shape).repartition("h")
    same = Window.partitionBy("h", "k").orderBy("doc_id", "a")
    head = F.struct("doc_id", "a")
    groups = groups.withColumn("first", F.first(head).over(same)).withColumn("rn", F.row_number().over(same))
    groups = groups.withColumn("kinds", F.sum((F.col("rn") == 1).cast("int")).over(Window.partitionBy("h")))
    whole = groups.where(head != F.col("first")).select("doc_id", F.col("a").alias("s"), (F.col("a") + F.col("size") + (window - 1)).alias("e"))

    wanted = (
        groups.where("rn = 1 and kinds > 1")
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("h", "a", "size", (F.col("kinds") > CROWDED).alias("crowded"))).alias("wanted"))
    )
    cut = texts.join(wanted, "doc_id").select("doc_id", "text", "wanted").mapInArrow(cut_task(window), "route long, doc_id long, a int, words binary")
    crowd = cut.where("words is null").select("doc_id", F.col("a").alias("s"), (F.col("a") + window).alias("e"))
    shared = cut.where("words is not null").repartition("route").mapInArrow(shard_task(window), span)
    return inner.unionByName(whole).unionByName(crowd).unionByName(shared)


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)``; ``kept`` is the words that stay, joined by one space."""
    texts = pick(docs, doc_id="doc_id", text="text").where("doc_id is not null")
    ranges = repeated_ranges(docs, window).groupBy("doc_id").agg(F.collect_list(F.struct("s", "e")).alias("ranges"))
    return (
        texts.join(ranges, "doc_id", "left")
        .select("doc_id", "text", "ranges")
        .mapInArrow(keep_task, "doc_id long, n_words long, n_removed long, kept string")
    )
