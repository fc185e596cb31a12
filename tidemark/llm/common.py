"""Helpers shared by the corpus operators: text slices, word hashes, scratch tables.

Words are runs of bytes other than space and 0x09-0x0D, as ``bytes.split`` cuts them.
Hashes are 64-bit; wherever a hash decides a result alone, the operator says so.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20

_rng = np.random.default_rng(20240607)
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
WORD_STEP = np.uint64(0xD6E8FEB86659FD93)
WORD_STEP_INVERSE = np.uint64(pow(int(WORD_STEP), -1, 2**64))
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def shared_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, or under the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, survives executors."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under fixed names; extra and clashing columns of the input are left behind."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def slices(batch: pa.RecordBatch, text: int = 1, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that each piece holds about ``limit`` bytes of text, or one longer text."""
    n = batch.num_rows
    if not n:
        return
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < n:
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def freed(task: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task, which at its end returns what Arrow holds in reserve: idle workers keep their memory beside other stages."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return run


def _raw(column: pa.Array) -> list:
    return column.cast(pa.large_binary()).to_pylist()


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in _raw(column)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(step: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), step, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_table(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of several texts: start and end byte in the joined buffer, hash, first word of each text, buffer."""
    joined = b" ".join(texts) + b" "
    data = np.frombuffer(joined, np.uint8)
    space = IS_SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2].astype(np.int64), edge[1::2].astype(np.int64)
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    first = np.concatenate([[0], np.searchsorted(starts, text_ends, "left")])
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64), first, data
    lengths = ends - starts
    letters = data[~space]
    at = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(len(letters)) - np.repeat(at, lengths)
    code = BYTE_CODE[letters] * powers(STEP, int(lengths.max()))[place]
    return starts, ends, mix(np.add.reduceat(code, at)), first, data


def run_hash(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = out * WORD_STEP + words[j : j + n]
    return mix(out)


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def seeded(*parts: object) -> int:
    """A 64-bit number from a stable hash of the parts."""
    return int.from_bytes(hashlib.blake2b("\x1f".join(map(str, parts)).encode(), digest_size=8).digest(), "little")
