"""Quality scores by a generalised additive model with pairwise interactions.

Features are counted over whole texts (letters, case, symbols, words, repetition, lines). Each is
cut into quantile bins; cyclic boosting gives every feature in turn one shallow tree on its bins,
added at a small rate into that feature's lookup table; then the same for the pairs of features
whose joint bins explain most of what is left. A score is the logistic of the summed table
entries, so scoring is binning and adding.

The model is fitted on at most about ``SAMPLE`` labelled rows, chosen by a hash of the id. Scoring
reads every text, without shuffle. Null text is an empty text and is scored. Labels that are null
are not learned; without two classes every score is the share of label 1 (0.5 without labels).
Repeated rows are scored each. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick, raw_texts, slices

SAMPLE = 8000
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 200, 60, 10
RATE, RIDGE = 0.1, 5.0

FEATURES = (
    "log_bytes", "log_words", "word_length", "longest_word", "upper", "digits", "marks", "stops", "bars", "beyond_ascii", "marked_words",
    "distinct_words", "distinct_pairs", "distinct_lines", "line_words", "capital_words", "short_words", "commonest_word",
)
UPPER, DIGIT = range(65, 91), range(48, 58)
STOPS = b".,;:?"
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and b not in STOPS and b != ord("|"))


def features(text: bytes) -> list[float]:
    n = max(len(text), 1)
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256) if text else np.zeros(256)
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    k = max(len(words), 1)
    size = [len(w) for w in words] or [0]
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    pairs = len(set(zip(words, words[1:], strict=False)))
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        sum(size) / k,
        np.log1p(max(size)),
        seen[UPPER].sum() / n,
        seen[DIGIT].sum() / n,
        seen[list(MARKS)].sum() / n,
        seen[list(STOPS)].sum() / n,
        seen[ord("|")] / n,
        seen[128:].sum() / n,
        sum(w[-1:] in MARK_SET for w in words) / k,
        len(counts) / k,
        pairs / max(len(words) - 1, 1),
        len(set(lines)) / max(len(lines), 1),
        np.log1p(len(words) / max(len(lines), 1)),
        sum(w[:1].isupper() for w in words) / k,
        sum(s <= 3 for s in size) / k,
        max(counts.values(), default=0) / k,
    ]


MARK_SET = frozenset(bytes([b]) for b in MARKS)


# --- fitting -----------------------------------------------------------------------
def leaf(g: float, h: float) -> float:
    return g / (h + RIDGE)


def gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def best_cut(g: np.ndarray, h: np.ndarray) -> int:
    """Bins left of the cut that explains most; 0 where no cut helps."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(left_g):
        return 0
    total = gain(left_g, left_h) + gain(g.sum() - left_g, h.sum() - left_h)
    k = int(total.argmax())
    return k + 1 if total[k] > gain(g.sum(), h.sum()) + 1e-9 else 0


def tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """A shallow tree on ordered bins, as a value per bin."""
    cut = best_cut(g, h) if depth else 0
    if not cut:
        return np.full(len(g), leaf(g.sum(), h.sum()))
    return np.concatenate([tree(g[:cut], h[:cut], depth - 1), tree(g[cut:], h[cut:], depth - 1)])


def pair_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """One cut on the first feature, then one on the second on either side."""
    best, value = -1.0, None
    for cut in range(1, len(g)):
        parts = [tree(g[part].sum(0), h[part].sum(0), 1) for part in (slice(0, cut), slice(cut, None))]
        score = sum((v * g[part].sum(0) - 0.5 * v * v * h[part].sum(0)).sum() for v, part in zip(parts, (slice(0, cut), slice(cut, None)), strict=True))
        if score > best:
            best, value = score, np.vstack([np.tile(parts[0], (cut, 1)), np.tile(parts[1], (len(g) - cut, 1))])
    return value if value is not None else np.zeros_like(g)


@dataclass
class Model:
    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for k, table in enumerate(self.tables):
            z += table[np.searchsorted(self.edges[k], x[:, k], "right")]
        bins = {k: np.searchsorted(self.coarse[k], x[:, k], "right") for pair in self.pairs for k in pair[:2]}
        for i, j, table in self.pairs:
            z += table[bins[i], bins[j]]
        return 1 / (1 + np.exp(-z))


def cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins))


def fit_table(x: np.ndarray, y: np.ndarray) -> Model:
    """``x``: rows by features, ``y``: 0 or 1."""
    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 1e-3), 1 - 1e-3)
        return Model(float(np.log(share / (1 - share))))
    model = Model(float(np.log(y.mean() / (1 - y.mean()))))
    model.edges = [cuts(c, BINS) for c in x.T]
    model.coarse = [cuts(c, PAIR_BINS) for c in x.T]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, c, "right") for e, c in zip(model.edges, x.T, strict=True)]
    z = np.full(len(y), model.base)

    def slopes():
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for k, b in enumerate(bins):
            g, h = slopes()
            size = len(model.tables[k])
            step = RATE * tree(np.bincount(b, g, size), np.bincount(b, h, size))
            model.tables[k] += step
            z += step[b]
    rough = [np.searchsorted(e, c, "right") for e, c in zip(model.coarse, x.T, strict=True)]
    g, h = slopes()

    def joint(i, j, v):
        n = len(model.coarse[j]) + 1
        return np.bincount(rough[i] * n + rough[j], v, (len(model.coarse[i]) + 1) * n).reshape(-1, n)

    ranked = sorted(((gain(joint(i, j, g), joint(i, j, h)).sum(), i, j) for i in range(x.shape[1]) for j in range(i)), reverse=True)
    chosen = [(i, j, np.zeros((len(model.coarse[i]) + 1, len(model.coarse[j]) + 1))) for _, i, j in ranked[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in chosen:
            g, h = slopes()
            step = RATE * pair_tree(joint(i, j, g), joint(i, j, h))
            table += step
            z += step[rough[i], rough[j]]
    model.pairs = chosen
    return model


def feature_rows(texts: list[bytes]) -> np.ndarray:
    return np.array([features(t) for t in texts], float).reshape(-1, len(FEATURES))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on the labelled rows the caller allows; ``labels`` has doc_id and quality."""
    labels = pick(labels, doc_id="doc_id", quality="quality").where("quality is not null and doc_id is not null")
    steps = 1 << 20
    keep = min(steps, -(-SAMPLE * steps // max(labels.count(), 1)))
    sample = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(steps)) < keep).limit(2 * SAMPLE)  # a bound for the broadcast

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                rows = feature_rows(raw_texts(piece.column(1)))
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(2), pa.array(list(rows), pa.list_(pa.float64()))], names=["doc_id", "quality", "x"])

    joined = pick(docs, doc_id="doc_id", text="text").join(F.broadcast(sample), "doc_id").select("doc_id", "text", F.col("quality").cast("int").alias("quality"))
    taken = joined.mapInArrow(task, "doc_id long, quality int, x array<double>").limit(4 * SAMPLE).collect()
    taken = sorted((r["doc_id"], r["quality"], list(r["x"])) for r in taken)
    return fit_table(np.array([r[2] for r in taken], float).reshape(-1, len(FEATURES)), np.array([r[1] for r in taken], float))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` of every row, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                rows = feature_rows(raw_texts(piece.column(1)))
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(shared.value.score(rows), pa.float64())], names=["doc_id", "score"])

    return pick(docs, doc_id="doc_id", text="text").mapInArrow(task, "doc_id long, score double")
