"""Language identification by error-correcting output codes.

Every language has a codeword. One binary classifier per bit weighs hashed letter trigrams
(log odds of the trigram among texts of the languages with the bit and those without, smoothed)
and averages them over the whole text. Decoding charges each codeword the logistic loss of
every bit's margin and takes the nearest; the share of the nearest is the score, and a text
whose runner-up is close is flagged ambiguous.

The model is fitted on a bounded sample of labelled rows: of each language about
``PER_LANGUAGE`` rows, chosen by a hash of their id. All trigrams of a text count; those of one
longer than ``WEIGHT`` weigh less each, so that it does not outweigh the others. Tasks count them;
sums per language and bucket reach the driver. Prediction reads whole texts, without shuffle.

Null text and text without a letter are ``und``, score 0, not ambiguous. Without labelled rows
everything is ``und``. Languages that are null are not learned. All rows are kept.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick, slices

PER_LANGUAGE = 1000
BUCKET_BITS = 15
# a longer text weighs as much as one of so many trigrams, in fixed point so that sums have no order
WEIGHT, POINT = 2000, 1 << 20
SCALES = (1, 2, 4, 8, 16, 32)
AMBIGUOUS = 0.1
UNDETERMINED = "und"

# letters and all bytes of other scripts stay; the rest of ASCII is a gap
KEPT = np.full(256, 0x20, np.uint32)
for _b in [*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]:
    KEPT[_b] = _b


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram buckets of all texts, gap trigrams as 0, and where each text's begin.

    A text's trigrams reach one gap before and after it, never into a neighbour.
    """
    raw = [t.lower().encode() for t in texts]
    data = KEPT[np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)]
    code = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)
    bucket[code == 0x202020] = 0
    begin = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
    return bucket, begin


def codewords(n: int) -> np.ndarray:
    """``n`` codewords as rows of +-1: all splits for few languages, else the best random code found."""
    if n == 1:
        return np.ones((1, 1), int)
    if n <= 5:
        splits = np.arange(1, 2 ** (n - 1))
        return np.where((splits[None, :] >> np.arange(n)[:, None]) & 1, -1, 1)
    bits, rng, best, far = 10 + 3 * int(np.ceil(np.log2(n))), np.random.default_rng(5), None, -1
    for _ in range(200):
        code = rng.choice([-1, 1], (n, bits))
        near = ((bits - code @ code.T) // 2 + bits * np.eye(n, dtype=int)).min()
        if near > far and (np.abs(code.sum(0)) < n).all():
            best, far = code, near
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    scale: float

    def margins(self, texts: list[str]) -> np.ndarray:
        bucket, begin = grams(texts)
        out = np.zeros((len(texts), self.weights.shape[1]))
        for k, (a, b) in enumerate(zip(begin[:-1], begin[1:], strict=True)):
            own = bucket[a : b - 1] if b - a > 1 else bucket[a:a]
            total = np.zeros(self.weights.shape[1])
            for lo in range(0, len(own), 1 << 17):
                total += self.weights[own[lo : lo + (1 << 17)]].sum(0, dtype=np.float64)
            out[k] = total / max(np.count_nonzero(own), 1)
        return out

    def shares(self, margins: np.ndarray) -> np.ndarray:
        """Share of each language: logistic loss of every codeword, turned around."""
        out, step = np.zeros((len(margins), len(self.code))), max(1, (1 << 21) // self.code.size)
        for lo in range(0, len(margins), step):
            z = -self.scale * margins[lo : lo + step, None, :] * self.code[None, :, :]
            loss = np.logaddexp(0, z).sum(2)
            e = np.exp(loss.min(1, keepdims=True) - loss)
            out[lo : lo + step] = e / e.sum(1, keepdims=True)
        return out

    def gains(self, texts: list[str], langs: list[str]) -> np.ndarray:
        """Sum of the log share of each text's language, under each of ``SCALES``."""
        margins, place = self.margins(texts), {x: i for i, x in enumerate(self.languages)}
        truth = [place[x] for x in langs]
        at = [Model(self.languages, self.code, self.weights, float(x)).shares(margins) for x in SCALES]
        return np.array([np.log(x[np.arange(len(truth)), truth] + 1e-12).sum() for x in at])


def weights(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigram buckets of a text and what each weighs, in units of ``1 / POINT``."""
    bucket, count = np.unique(grams([text])[0], return_counts=True)
    return bucket, count * (POINT * WEIGHT) // max(int(count.sum()), WEIGHT)


def weigh(languages: list[str], counts: np.ndarray) -> Model:
    """Model from trigram counts by language and bucket, its scale not yet chosen. Uses up ``counts``."""
    share = counts
    share += 0.5
    share /= share.sum(1, keepdims=True)  # each language weighs the same
    code = codewords(len(languages))
    plus, minus = (code > 0).astype(float), (code < 0).astype(float)
    mean = lambda side: (side.T @ share + 1e-9) / np.maximum(side.sum(0), 1)[:, None]
    weights = (np.log(mean(plus)) - np.log(mean(minus))).T if len(languages) > 1 else np.zeros((1 << BUCKET_BITS, code.shape[1]))
    weights[0] = 0
    return Model(languages, code, weights.astype(np.float32), 1.0)


def fit_rows(rows: list[tuple[str, str]]) -> Model | None:
    """Model from ``(text, language)`` rows."""
    if not rows:
        return None
    languages = sorted({lang for _, lang in rows})
    counts = np.zeros((len(languages), 1 << BUCKET_BITS))
    for text, lang in rows:
        bucket, weight = weights(text)
        counts[languages.index(lang), bucket] += weight
    model = weigh(languages, counts / POINT)
    model.scale = float(SCALES[int(np.argmax(model.gains(*map(list, zip(*rows, strict=True)))))])
    return model


def count_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weights of each text's trigrams, by language and bucket."""
    for batch in batches:
        for piece in slices(batch):
            for lang, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                bucket, weight = weights(text)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(bucket), pa.string()), pa.array(bucket, pa.int32()), pa.array(weight, pa.int64())], names=["lang", "bucket", "n"])


def fit(docs: DataFrame) -> Model | None:
    """Fits on a bounded sample of rows with a language; the caller chooses which rows may be learned from."""
    rows = pick(docs, doc_id="doc_id", text="text", lang="lang").where("text is not null and lang is not null")
    found = rows.groupBy("lang").count().orderBy("lang").collect()
    if not found:
        return None
    # hash buckets kept per language, so that about PER_LANGUAGE rows stay
    steps = 1 << 20
    keep = F.create_map(*[F.lit(x) for r in found for x in (r["lang"], min(steps, -(-PER_LANGUAGE * steps // r["count"])))])
    sample = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(steps)) < keep[F.col("lang")]).select("lang", "text")
    sums = sample.mapInArrow(count_task, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sums.column("lang").to_pylist()
    languages = sorted(set(langs))
    if not languages:
        return None
    place, counts = {x: i for i, x in enumerate(languages)}, np.zeros((len(languages), 1 << BUCKET_BITS))
    counts[[place[x] for x in langs], sums.column("bucket").to_numpy()] = sums.column("n").to_numpy() / POINT
    model = weigh(languages, counts)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                gains = shared.value.gains(piece.column(1).to_pylist(), piece.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(range(len(SCALES)), pa.int32()), pa.array(gains)], names=["scale", "gain"])

    gains = {r["scale"]: r["gain"] for r in sample.mapInArrow(task, "scale int, gain double").groupBy("scale").agg(F.sum("gain").alias("gain")).collect()}
    model.scale = float(SCALES[max(gains, key=lambda k: (gains[k], -k))])
    return model


def predict_task(model: Model | None, place: int):
    import regex

    letter = regex.compile(r"\p{L}")

    def task(batch: pa.RecordBatch) -> tuple[list[str], np.ndarray, np.ndarray]:
        texts = [t or "" for t in batch.column(place).to_pylist()]
        lang, score, unsure = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        known = [i for i, t in enumerate(texts) if letter.search(t)] if model else []
        if known:
            shares = model.shares(model.margins([texts[i] for i in known]))
            top = np.sort(shares, 1)[:, ::-1]
            for i, best in zip(known, shares.argmax(1).tolist(), strict=True):
                lang[i] = model.languages[best]
            score[known] = top[:, 0]
            unsure[known] = (top[:, 0] - top[:, 1] < AMBIGUOUS) if top.shape[1] > 1 else False
        return lang, score, unsure

    return task


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``(doc_id, lang_pred, score, ambiguous)`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = predict_task(shared.value, 1)
        for batch in batches:
            for piece in slices(batch):
                lang, score, unsure = judge(piece)
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(lang), pa.array(score), pa.array(unsure)], names=["doc_id", "lang_pred", "score", "ambiguous"])

    return pick(docs, doc_id="doc_id", text="text").mapInArrow(task, "doc_id long, lang_pred string, score double, ambiguous boolean")


def keep_identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents whose language is determined and not ambiguous, with all their columns."""
    shared, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = predict_task(shared.value, place)
        for batch in batches:
            for piece in slices(batch, place):
                lang, _, unsure = judge(piece)
                yield piece.filter(pa.array((np.array(lang) != UNDETERMINED) & ~unsure))

    return docs.mapInArrow(task, docs.schema)


def fold(docs: DataFrame, folds: int):
    """``crc32`` of the id as text, modulo ``folds``; null without id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
