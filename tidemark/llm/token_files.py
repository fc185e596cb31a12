"""Token ids in ORC files: integer run-length encoding, row indexes and Bloom filters on document ids.

Documents are dealt to tasks by ranges of ``doc_id`` before they are encoded, so one shuffle of the
texts gives files in ascending order and each text is encoded once. A row holds up to ``PIECE`` ids
of a document, its ``doc_id``, the file's number ``part``, the document's place ``at`` in the part,
its length ``n_tokens`` and the piece's place ``skipped`` in the document. All are integers, which
ORC stores as run lengths, deltas or bit-packed groups; minima and maxima a stripe and every
``INDEX_ROWS`` rows, and the Bloom filters, let a reader skip what an id cannot be in. Stripes are
read in parallel. Pieces bound what a writer and a reader's batch hold, however long a document is.

A small manifest beside the files lists every part with its ids before it (``base``); a document's
``start`` is ``base + at``. It comes from the files' own ``at`` and ``n_tokens`` columns after the
write, so a repeated task changes nothing. Only one row for each part reaches the driver.

Encoding is that of the tokenizers library without added special tokens, then the end id. Texts are
cut into words by the vocabulary's pattern, a slice of texts in one array pass, and the library's model
encodes the distinct words that a task does not remember: a word's ids do not depend on its neighbours.
Only the distinct words of a slice become Python strings. Special tokens in a text become their ids.

A null text is empty: its only id is the end id. Rows without id come first. Rows that repeat an id
are documents each, in the order of a hash of their text; the range split falls between them, so a
frequent id is not one task. Extra columns are ignored. An empty table gives empty files.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import byte_letters
from tidemark.llm.common import pick, shared_dir, slices

PIECE = 4096
INDEX_ROWS = 1000
STRIPE_BYTES = 16 << 20
FALSE_HITS = 0.01
REMEMBERED = 200_000
# A longer text is encoded in stretches. No word of the pattern, and no special token, goes from a letter on to a space.
STRETCH = 1 << 20
BREAK = re.compile("(?<=[A-Za-z])(?= )")
# What the vocabulary's pattern takes a character for; an edge stands between two texts.
OTHER, LETTER, DIGIT, WHITE, EDGE = range(5)
SPACE, QUOTE = ord(" "), ord("'")
ROW = "doc_id long, part int, at long, n_tokens long, skipped long, ids array<int>"
MANIFEST = "part int, first_doc long, last_doc long, documents long, tokens long, base long"


def stretches(text: str) -> Iterator[str]:
    at = 0
    while (m := BREAK.search(text, at + STRETCH)) is not None:
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def groups(texts: list[str]) -> Iterator[list[tuple[int, str]]]:
    """Stretches with the places of their texts, about ``STRETCH`` characters at a time."""
    group, size = [], 0
    for k, text in enumerate(texts):
        for stretch in stretches(text):
            group.append((k, stretch))
            size += len(stretch)
            if size >= STRETCH:
                yield group
                group, size = [], 0
    if group:
        yield group


@lru_cache(1)
def kinds() -> np.ndarray:
    """Kind of every code point."""
    import regex

    out = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    every = "".join(map(chr, range(len(out))))
    for kind, run in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (WHITE, r"\s+")):
        for m in regex.finditer(run, every):
            out[m.start() : m.end()] = kind
    return out


def word_starts(codes: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Whether ``bpe.PATTERN`` begins a word at each character. An edge comes first and last, and is a word of its own."""
    start = kind == EDGE
    start[1:] |= kind[1:] != kind[:-1]
    # white space leaves its last character to what follows; a space joins it
    last = np.flatnonzero((kind[:-1] == WHITE) & (kind[1:] != WHITE) & (kind[1:] != EDGE))
    start[last] = True
    start[last[codes[last] == SPACE] + 1] = False
    # 's 't 'm 'd 're 've 'll, where the quote begins a word; what follows begins the next
    quote = np.flatnonzero(codes[1:] == QUOTE) + 1
    quote = quote[(kind[quote - 1] != OTHER) & (codes[quote - 1] != SPACE)]
    after = codes[quote + 1]
    short = quote[np.isin(after, [*b"stmd"])]
    long = quote[np.isin(after, [*b"rvl"])]
    long = long[codes[long + 2] == np.where(codes[long + 1] == ord("l"), ord("l"), ord("e"))]
    start[np.append(short, long) + 1] = False
    start[np.append(short + 2, long + 3)] = True
    return start


def cut_words(parts: list[str], special: list[int]) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Words of all parts with an edge before, between and after them, and the places of the edges."""
    text = "\0" + "".join(part + "\0" for part in parts)
    raw, codes = text.encode(), np.frombuffer(text.encode("utf-32-le"), np.uint32)
    edge = np.cumsum([0, *(len(part) + 1 for part in parts)])
    kind = np.concatenate([kinds()[codes[lo : lo + STRETCH]] for lo in range(0, len(codes), STRETCH)])
    kind[edge] = EDGE
    start = word_starts(codes, kind)
    for k in special:
        start[edge[k] + 2 : edge[k + 1]] = False
    at = np.flatnonzero(start)
    edge = np.searchsorted(at, edge)
    if len(raw) > len(codes):
        width = sum((codes >= least for least in (0x80, 0x800, 0x10000)), np.ones(len(codes), np.uint8))
        at = np.append(0, np.cumsum(np.add.reduceat(width, at, dtype=np.int64))[:-1])
    return edge, pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.append(at, len(raw))), pa.py_buffer(raw)).dictionary_encode()


class Known(dict):
    """Words with the places of their ids, in the order of these."""

    def __init__(self, encode_words: Callable[[list[str]], list[list[int]]]):
        self.encode_words, self.now = encode_words, 0
        self.flat, self.size, self.met = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def places(self, words: list[str]) -> np.ndarray:
        """Places of distinct words; new ones are encoded."""
        out = np.fromiter(map(self.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(out < 0)
        new = [words[i] for i in missing.tolist()]
        coded = self.encode_words(new)
        out[missing] = np.arange(len(self), len(self) + len(new))
        self.update(zip(new, out[missing].tolist(), strict=True))
        self.flat = np.append(self.flat, np.fromiter(chain.from_iterable(coded), np.int32))
        self.size = np.append(self.size, np.fromiter(map(len, coded), np.int64, len(coded)))
        self.met = np.append(self.met, np.zeros(len(new), np.int64))
        self.now += 1
        self.met[out] = self.now
        return out

    def gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids held at the places, one after another, and where those of each place end."""
        size, first = self.size[places], (np.cumsum(self.size) - self.size)[places]
        ends = np.cumsum(size)
        ids = np.empty(size.sum(), np.int32)
        for lo in range(0, len(places), STRETCH):
            some = slice(lo, lo + STRETCH)
            at, begin = np.repeat(first[some] - ends[some] + size[some], size[some]), ends[lo] - size[lo]
            at += np.arange(begin, begin + len(at))
            ids[begin : begin + len(at)] = self.flat[at]
        return ids, ends

    def forget(self, most: int) -> None:
        """Keeps the words met last."""
        keep = np.sort(np.argsort(-self.met, kind="stable")[:most])
        words = [*self]
        self.flat, self.size, self.met = self.gather(keep)[0], self.size[keep], self.met[keep]
        self.clear()
        self.update((words[i], place) for place, i in enumerate(keep.tolist()))


class Encoder:
    """Ids by the tokenizers library, remembered by word: at twice ``REMEMBERED`` words the half met last stays."""

    def __init__(self, path: str, end_id: int = 0):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path).model
        with open(path, encoding="utf-8") as f:
            self.special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        # a byte that is in no text stands between words
        self.letters = {b: c for c, b in byte_letters().items()} | {0xFF: "\n"}
        self.end_id = end_id
        self.known = Known(self.encode_words)

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The library's ids of words of the pattern, and the ids of special tokens."""
        spelled = "\udcff".join(words).encode("utf-8", "surrogateescape").decode("latin-1").translate(self.letters).split("\n") if words else []
        tokenize, special = self.model.tokenize, self.special
        return [[special[word]] if word in special else [t.id for t in tokenize(letters)] for word, letters in zip(words, spelled, strict=True)]

    def split(self, text: str) -> list[str]:
        """Text and special tokens by turns."""
        return self.cut.split(text) if self.special and any(s in text for s in self.special) else [text]

    def encode_parts(self, parts: list[str], special: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts in one array, and how many each part has. ``special`` are the places of special tokens."""
        edge, words = cut_words(parts, special)
        places = self.known.places(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids, ends = self.known.gather(places[np.delete(words.indices.to_numpy(), edge)])
        return ids, np.diff(np.append(0, ends)[edge - np.arange(len(edge))])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, the end id after each, and how many each text has."""
        ids, n = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64)
        for group in groups(texts):
            owner, parts, special = [], [], []
            for k, stretch in group:
                for turn, part in enumerate(self.split(stretch)):
                    if turn % 2:
                        special.append(len(parts))
                    owner.append(k)
                    parts.append(part)
            found, sizes = self.encode_parts(parts, special)
            ids.append(found)
            np.add.at(n, owner, sizes)
            if len(self.known) > 2 * REMEMBERED:
                self.known.forget(REMEMBERED)
        return np.insert(np.concatenate(ids), np.cumsum(n), self.end_id), n + 1


@lru_cache(2)
def encoder(path: str, end_id: int) -> Encoder:
    return Encoder(path, end_id)


def pieces(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Rows of the file format, in ascending order of ``doc_id`` over the partitions and within each."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at, coder = TaskContext.get().partitionId(), 0, encoder(path, end_id)
        for batch in batches:
            for cut in slices(batch):
                ids, n = coder.encode([t or "" for t in cut.column(1).to_pylist()])
                begins = at + np.cumsum(n) - n
                at += int(n.sum())
                rows = -(-n // PIECE)
                doc = np.repeat(np.arange(len(n)), rows)
                skipped = (np.arange(len(doc)) - np.repeat(np.cumsum(rows) - rows, rows)) * PIECE
                ends = np.append(0, np.cumsum(np.minimum(n[doc] - skipped, PIECE))).astype(np.int32)
                columns = [cut.column(0).take(pa.array(doc)), pa.array(np.full(len(doc), part, np.int32)), pa.array(begins[doc]), pa.array(n[doc]), pa.array(skipped), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "at", "n_tokens", "skipped", "ids"])

    order = [F.col("doc_id").asc_nulls_first(), F.col("_text").asc(), F.col("_row").asc()]
    docs = pick(docs, doc_id="doc_id", text="text").withColumns({"_text": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    dealt = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select("doc_id", "text").mapInArrow(task, ROW)


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int = 0) -> None:
    """Encodes every document and writes files under ``folder/tokens`` and ``folder/manifest``."""
    spark = docs.sparkSession
    options = {"compression": "zstd", "orc.stripe.size": STRIPE_BYTES, "orc.rows.between.memory.checks": INDEX_ROWS // 2, "orc.create.index": "true", "orc.row.index.stride": INDEX_ROWS, "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": FALSE_HITS}
    pieces(docs, path, end_id).write.options(**options).orc(f"{folder}/tokens")
    seen = token_rows(spark, folder).where("skipped = 0").groupBy("part").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"), F.count("*").alias("documents"), F.sum("n_tokens").alias("tokens"))
    rows, base = [], 0
    for r in sorted(seen.collect()):
        rows.append((*r, base))
        base += r.tokens
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.orc(f"{folder}/manifest")


def token_rows(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(ROW).orc(f"{folder}/tokens")


def read_tokens(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Pieces ``(doc_id, start, n_tokens, skipped, ids)``; ``doc_ids`` reach the files' indexes and filters."""
    rows = token_rows(spark, folder)
    if doc_ids is not None:
        rows = rows.where(F.col("doc_id").isin([int(i) for i in doc_ids]))
    base = spark.read.schema(MANIFEST).orc(f"{folder}/manifest").select("part", "base")
    return rows.join(base, "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "skipped", "ids")


# --- checksums ---------------------------------------------------------------------
# Fixed value: the reflected CRC-32 polynomial.
POLYNOMIAL = 0xEDB88320


def times(a: int, b: int) -> int:
    """Product of two reflected polynomials modulo the CRC polynomial."""
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = b >> 1 ^ (POLYNOMIAL if b & 1 else 0)
    return out


@lru_cache(4096)
def zeros_after(n_bytes: int) -> int:
    """x to the power of 8 * n_bytes: what n zero bytes after a message multiply its checksum by."""
    out, square, n = 1 << 31, 1 << 23, n_bytes
    while n:
        if n & 1:
            out = times(out, square)
        square, n = times(square, square), n >> 1
    return out


def document_checksums(rows: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` from pieces, ids as little-endian unsigned 32-bit integers.

    The checksum of a document is the exclusive or of its pieces' checksums, each moved over the
    bytes that follow it. So pieces are digested where they are read, in any order.
    """

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(4)
            flat, ends = ids.values.to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy()
            sums, sizes = [], np.diff(ends)
            for n, skipped, a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                crc, after = zlib.crc32(flat[a:b].data), n - skipped - (b - a)
                sums.append(times(zeros_after(4 * after), crc) if after else crc)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes.astype(np.int64)), pa.array(sums, pa.int64())], names=["doc_id", "start", "read", "crc"])

    parts = rows.select("doc_id", "start", "n_tokens", "skipped", "ids").mapInArrow(task, "doc_id long, start long, read long, crc long")
    # a document has at least the end id, so its start is its own
    return parts.groupBy("start", "doc_id").agg(F.sum("read").alias("n_tokens"), F.bit_xor("crc").alias("ids_crc32")).select("doc_id", "start", "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """Writes all documents to the shared folder and digests what the files hold."""
    folder = shared_dir(docs.sparkSession)
    write_tokens(docs, folder, path, end_id)
    return document_checksums(read_tokens(docs.sparkSession, folder))
