"""Secret scans: fixed patterns, and probabilistic automata inferred from what they find.

Base patterns label credentials of three kinds. All documents are read for labelled values, and
the ``VALUES`` of each kind with the least hashes grow a prefix tree over character classes. States
of one depth whose continuations agree within Hoeffding's bound are merged first, so that values of a
fixed length keep it; then states of different depths, which makes loops of what repeats. Their
successors are merged with them. A state with fewer than ``SURE`` visits is no evidence: it joins the
state of its depth that most likely continues as it does, or stays by itself. Characters of a value from ``DEPTH`` on
share one state. A background automaton is inferred in the same way from the ``TOKENS`` ordinary tokens
with the least hashes of a bounded sample of documents (``SAMPLE`` rows, by a hash of the id).

Every other run of eight or more token characters is then scored. It becomes a span of kind ``format``
when an automaton accepts it: it ends where at least ``SURE`` labelled values end; its log likelihood lies
no more standard deviations under the expected one than that of all but the ``TAIL`` least likely of these (each
judged without its own counts); and its likelihood per character is more than the background gives it.

Spans are code points, end exclusive. Base spans always stay; added ones never touch them. Whole
texts are scanned, without shuffle, whatever their length. Null text has no spans. All rows are kept,
repeated ones too. Without labelled values (or an empty table) only base patterns count. Extra columns are not
read by ``scan``, whose columns are ``doc_id`` and ``found``, and pass through ``mask`` unchanged, but for ``n_chars``.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from math import log, log2, sqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick, slices, stored

SAMPLE = 30_000
VALUES = 600
TOKENS = 3000
DEPTH = 256
TAIL = 0.05
ALPHA = 0.05
SURE = 10
SMOOTH = 0.05
MASK = "[SECRET]"
KINDS = ("assign", "access", "hex", "format")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a run of 20 or more from its first AKIA
HEX = re.compile(r"[0-9a-f]{24,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")

CLASSES = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", *"+/_.=-")
CLASS_OF = bytes(next((k for k, group in enumerate(CLASSES) if chr(c) in group), 0) for c in range(256))
END = len(CLASSES)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """Start, kind number, end and value of base matches, in order of start and kind."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out)


def others(text: str, spans: list[tuple[int, int, int, str]]) -> Iterator[re.Match]:
    """Runs of token characters that touch no base span."""
    starts, reach = [s[0] for s in spans], []
    for s in spans:
        reach.append(max(s[2], reach[-1] if reach else 0))
    for m in TOKEN.finditer(text):
        k = bisect_left(starts, m.end())
        if not k or reach[k - 1] <= m.start():
            yield m


# --- inference ---------------------------------------------------------------------
class Value(NamedTuple):
    """The first ``DEPTH`` classes of a value, and how often each class follows them."""

    head: bytes
    rest: tuple[int, ...]

    @staticmethod
    def of(text: str) -> Value:
        classes = text.encode("ascii").translate(CLASS_OF)
        return Value(classes[:DEPTH], tuple(classes.count(c, DEPTH) for c in range(END)) if len(classes) > DEPTH else ())

    def __len__(self) -> int:
        return len(self.head) + sum(self.rest)


class State(NamedTuple):
    """Steps by class, with the most usual one in place of those never seen; log2 chances of each class (of one of its
    characters) and the end; their expectation and variance."""

    to: dict[int, int]
    step: list[int | None]
    chance: list[float]
    mean: float
    spread: float


class Automaton:
    """Deterministic states with counts of next classes and ends; merged states share a root."""

    def __init__(self):
        self.to: list[dict[int, int]] = []
        self.count: list[dict[int, int]] = []
        self.total: list[int] = []
        self.same: list[int] = []
        self.unlike: set[tuple[int, int]] = set()
        self.state()
        self.tail: int | None = None

    def state(self) -> int:
        self.to.append({})
        self.count.append({})
        self.total.append(0)
        self.same.append(len(self.same))
        return len(self.same) - 1

    def root(self, s: int) -> int:
        while self.same[s] != s:
            self.same[s] = s = self.same[self.same[s]]
        return s

    def see(self, s: int, c: int, n: int = 1) -> None:
        self.total[s] += n
        self.count[s][c] = self.count[s].get(c, 0) + n

    def add(self, value: Value) -> None:
        at = 0
        for depth, c in enumerate(value.head, 1):
            self.see(at, c)
            if c not in self.to[at]:
                if depth == DEPTH and self.tail is None:
                    self.tail = self.state()
                self.to[at][c] = self.tail if depth == DEPTH else self.state()
            at = self.to[at][c]
        for c, n in enumerate(value.rest):
            if n:
                self.see(at, c, n)
                self.to[at][c] = at
        self.see(at, END)

    def alike(self, a: int, b: int) -> bool:
        """Whether two states continue alike, and their successors too, as far as they were visited often enough to tell."""
        came: dict[tuple[int, int], tuple[int, int] | None] = {(a, b): None}
        todo = [(a, b)]
        while todo:
            pair = a, b = todo.pop()
            n, m = self.total[a], self.total[b]
            if min(n, m) < SURE:
                continue
            bound = sqrt(0.5 * log(2 / ALPHA)) * (1 / sqrt(n) + 1 / sqrt(m))
            count, other = self.count[a], self.count[b]
            if pair in self.unlike or any(abs(count.get(c, 0) / n - other.get(c, 0) / m) > bound for c in count.keys() | other.keys()):
                while pair:  # so are all pairs that lead here
                    self.unlike.add(pair)
                    pair = came[pair]
                return False
            for c in self.to[a].keys() & self.to[b].keys():
                step = self.root(self.to[a][c]), self.root(self.to[b][c])
                if step[0] != step[1] and step not in came:
                    came[step] = pair
                    todo.append(step)
        return True

    def join(self, a: int, b: int) -> None:
        """Makes ``b`` one state with ``a``, and their successors by the same class."""
        self.unlike.clear()
        todo = [(a, b)]
        while todo:
            a, b = (self.root(s) for s in todo.pop())
            if b == 0:  # the start keeps its number
                a, b = b, a
            if a == b:
                continue
            self.same[b] = a
            for c, n in self.count[b].items():
                self.see(a, c, n)
            for c, child in self.to[b].items():
                if c in self.to[a]:
                    todo.append((self.to[a][c], child))
                else:
                    self.to[a][c] = child

    def likely(self, a: int, b: int) -> float | None:
        """Log likelihood of what follows ``b`` after ``a``; None where some of it never does."""
        if not self.count[b].keys() <= self.count[a].keys():
            return None
        return sum(n * log(self.count[a][c] / self.total[a]) for c, n in self.count[b].items())

    def layer(self, states: list[int]) -> list[int]:
        """Merges compatible states of one depth, often visited ones first."""
        kept: list[int] = []
        for s in sorted(states, key=lambda s: (-self.total[s], s)):
            if self.total[s] >= SURE:
                like = next((k for k in kept if self.alike(k, s)), None)
            else:
                chances = [(x, -k) for k in kept if (x := self.likely(k, s)) is not None]
                like = -max(chances)[1] if chances else None
            if like is None:
                kept.append(s)
            else:
                self.join(like, s)
        return kept

    def merge(self) -> Automaton:
        """Merges by depth, then across depths in order from the start. States where all values end stay apart, a format each."""
        layers, done = [[0]], {0}
        while layers[-1]:
            below = {self.root(t) for s in layers[-1] for t in self.to[s].values()} - done
            layers.append(self.layer(sorted(below)))
            done.update(layers[-1])
        kept = [0]
        for s in (s for states in layers[1:] for s in states):
            if self.same[s] != s or s in kept:
                continue
            for k in kept if self.total[s] >= SURE and self.to[s] else ():
                if self.total[k] >= SURE and self.alike(k, s):
                    self.join(k, s)
                    kept = [k for k in kept if self.same[k] == k]
                    break
            else:
                kept.append(s)
        return self

    def chance(self, s: int, c: int, out: int = 0) -> float:
        """Log2 chance of a class (of one of its characters) or the end, smoothed, without ``out`` of its visits."""
        p = (self.count[s].get(c, 0) - out + SMOOTH) / (self.total[s] - out + SMOOTH * (END + 1))
        return log2(p) - (log2(len(CLASSES[c])) if c < END else 0)

    def pack(self) -> dict[int, State]:
        """Reachable states by number."""
        out: dict[int, State] = {}
        todo = [0]
        while todo:
            s = todo.pop()
            if s in out:
                continue
            to = {c: self.root(t) for c, t in self.to[s].items()}
            usual = to[max(to, key=lambda c: (self.count[s][c], -c))] if to else None
            chance = [self.chance(s, c) for c in range(END + 1)]
            share = [2**x * (len(CLASSES[c]) if c < END else 1) for c, x in enumerate(chance)]
            mean = sum(p * x for p, x in zip(share, chance, strict=True))
            spread = sum(p * (x - mean) ** 2 for p, x in zip(share, chance, strict=True))
            out[s] = State(to, [to.get(c, usual) for c in range(END)], chance, mean, spread)
            todo += to.values()
        return out

    def least(self, values: list[Value]) -> dict[int, float]:
        """By state where ``SURE`` values or more end: how far all but ``TAIL`` of them are from the expected log likelihood at worst, each without its own counts."""
        ends: dict[int, list[float]] = {}
        states = self.pack()
        for v in values:
            at, over, spread = 0, 0.0, 0.0
            for c in v.head:
                over += self.chance(at, c, 1) - states[at].mean
                spread += states[at].spread
                at = states[at].to[c]
            over += sum(n * (states[at].chance[c] - states[at].mean) for c, n in enumerate(v.rest) if n)
            over += self.chance(at, END, 1) - states[at].mean
            spread += (sum(v.rest) + 1) * states[at].spread
            ends.setdefault(at, []).append(over / sqrt(spread))
        return {s: float(np.quantile(x, TAIL, method="lower")) for s, x in ends.items() if len(x) >= SURE}


def likelihood(states: dict[int, State], token: str) -> float:
    """Mean log2 likelihood per character. An unseen continuation starts again."""
    at, total = 0, 0.0
    for c in token.encode("ascii").translate(CLASS_OF):
        total += states[at].chance[c]
        at = states[at].to.get(c, 0)
    return (total + states[at].chance[END]) / len(token)


def accepted(states: dict[int, State], least: dict[int, float], classes: bytes) -> float | None:
    """Mean log2 likelihood per character of a token in the learned format; None for any other. A step never seen has its
    smoothed chance and goes where the state mostly goes. How far the log likelihood is from the one expected along the
    path, in standard deviations, is comparable between formats of one kind, whatever their alphabets."""
    at = 0
    for c in classes:
        if (at := states[at].step[c]) is None:
            return None
    if at not in least:
        return None
    at, total, over, spread = 0, 0.0, 0.0, 0.0
    for c in (*classes, END):
        one = states[at]
        total += one.chance[c]
        over += one.chance[c] - one.mean
        spread += one.spread
        at = one.step[c] if c < END else at
    return total / len(classes) if over / sqrt(spread) >= least[at] else None


def grown(values: list[Value]) -> Automaton:
    tree = Automaton()
    for v in values:
        tree.add(v)
    return tree.merge()


def infer(values: list[str]) -> dict[int, State]:
    return grown([Value.of(v) for v in values]).pack()


class Held:
    """The distinct values of one kind with the least hashes, at most ``2 * most`` of them at a time."""

    def __init__(self, most: int):
        self.most, self.own, self.reach = most, {}, 1 << 63

    def add(self, text: str) -> None:
        h = xxhash.xxh64_intdigest(text, 42)
        h -= h >> 63 << 64
        if h < self.reach and h not in self.own:
            self.own[h] = Value.of(text)
            if len(self.own) >= 2 * self.most:
                self.own = dict(heapq.nsmallest(self.most, self.own.items()))
                self.reach = max(self.own)


def fit(docs: DataFrame) -> dict | None:
    """Automata of the kinds found with their thresholds, and the background. Values are told apart by 64 bits."""
    docs = pick(docs, doc_id="doc_id", text="text").where("text is not null")
    steps = 1 << 20
    keep = min(steps, -(-SAMPLE * steps // max(docs.count(), 1)))
    marked = docs.withColumn("background", F.pmod(F.xxhash64("doc_id"), F.lit(steps)) < keep)
    most = (VALUES, VALUES, VALUES, TOKENS)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Held(n) for n in most]
        for batch in batches:
            for piece in slices(batch):
                for text, background in zip(piece.column(1).to_pylist(), piece.column(2).to_pylist(), strict=True):
                    spans = base_spans(text)
                    for _, k, _, v in spans:
                        held[k].add(v)
                    for m in others(text, spans) if background else ():
                        held[3].add(m[0])
        rows = [(k, v.head, v.rest, h) for k, one in enumerate(held) for h, v in one.own.items()]
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        types = pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.int64()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["kind", "head", "rest", "h"])

    found = stored(marked.mapInArrow(task, "kind int, head binary, rest array<long>, h long")).distinct()
    by_kind: list[list[Value]] = []
    for kind in range(4):
        # the least hashes of each kind: bounded, and the same whatever the partitions
        rows = found.where(F.col("kind") == kind).orderBy("h", "head", "rest").limit(most[kind]).collect()
        by_kind.append([Value(bytes(r["head"]), tuple(r["rest"])) for r in rows])
    labelled = [v for v in by_kind[:3] if len(v) >= SURE]
    if not labelled:
        return None
    trees = [grown(v) for v in labelled]
    return {
        "background": grown(by_kind[3] or [Value.of("a")]).pack(),
        "kinds": [(t.pack(), t.least(v)) for t, v in zip(trees, labelled, strict=True)],
    }


def added(text: str, spans: list[tuple[int, int, int, str]], model: dict | None) -> list[tuple[int, int, int, float]]:
    """Start, kind number, end and score of spans that the automata add."""
    out = []
    for m in others(text, spans) if model else ():
        classes = m[0].encode("ascii").translate(CLASS_OF)
        scores = [x for states, least in model["kinds"] if (x := accepted(states, least, classes)) is not None]
        if scores and (gain := max(scores) - likelihood(model["background"], m[0])) > 0:
            out.append((m.start(), 3, m.end(), gain))
    return out


def scan(docs: DataFrame, model: dict | None) -> DataFrame:
    """``(doc_id, found)``: spans as kind, start, end, base and score, by start and kind."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())])

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                rows = []
                for text in piece.column(1).to_pylist():
                    base = base_spans(text or "")
                    all_ = sorted([(s, k, e, None) for s, k, e, _ in base] + added(text or "", base, shared.value))
                    rows.append([{"kind": KINDS[k], "start": s, "end": e, "base": k < 3, "score": x} for s, k, e, x in all_])
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(rows, pa.list_(span))], names=["doc_id", "found"])

    shape = "doc_id long, found array<struct<kind:string,start:long,end:long,base:boolean,score:double>>"
    return pick(docs, doc_id="doc_id", text="text").mapInArrow(task, shape)


def masked(text: str, model: dict | None) -> str:
    base = base_spans(text)
    out, at = [], 0
    for start, _, end, _ in sorted(base + added(text, base, model)):
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*out, text[at:]]) if at else text


def mask(docs: DataFrame, model: dict | None) -> DataFrame:
    """The documents with every span replaced by ``MASK``; ``n_chars`` follows where it is a column."""
    shared, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, place):
                old = piece.column(place).to_pylist()
                new = [None if t is None else masked(t, shared.value) for t in old]
                columns = list(piece.columns)
                columns[place] = pa.array(new, piece.schema.field(place).type)
                if chars is not None:
                    counts = [n if a == b else len(b) for n, a, b in zip(columns[chars].to_pylist(), old, new, strict=True)]
                    columns[chars] = pa.array(counts, piece.schema.field(chars).type)
                yield pa.RecordBatch.from_arrays(columns, schema=piece.schema)

    return docs.mapInArrow(task, docs.schema)
