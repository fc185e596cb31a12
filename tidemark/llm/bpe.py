"""Byte-level BPE encoding and decoding by speculation and verification.

A text is cut into words by the vocabulary's pattern. New words of a slice of texts are
encoded together: greedy longest match proposes tokens, one array pass asks of every adjacent
pair whether the merges would leave it apart, and only words with a failing pair (or with a
token that its own merges do not give) are merged exactly. A row of tokens that each encode to
themselves is the encoding of its bytes if and only if every adjacent pair stands.

Words and their ids are remembered within a task, up to twice ``REMEMBERED``. No shuffle; a task holds a
slice of texts. Special tokens in a text become their ids, as the file's own library does.

Null text encodes to no ids. All rows are kept, repeated ones too. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import freed, pick, slices

REMEMBERED = 150_000
SHORT = 64
NONE_RANK = 2**62
NONE = np.int64(NONE_RANK)
# Splits text before merging. Fixed value of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same cut for texts of these characters alone, where the plain ``re`` module can make it.
LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
PLAIN_TEXT = re.compile(f"[\t\n\r\\x20-\\x7e{LATIN}]*")
PLAIN_PATTERN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LATIN}]+| ?[0-9]+| ?[^\s{LATIN}0-9]+|\s+(?!\S)|\s+")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: printable Latin-1 is itself."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        letters = byte_letters()
        spell = lambda token: bytes(letters[c] for c in token)
        ids = data["model"]["vocab"]
        self.id_of = {spell(t): i for t, i in ids.items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        n = max([*ids.values(), *special.values()]) + 1
        self.bytes_of = [b""] * n
        for spelled, i in self.id_of.items():
            self.bytes_of[i] = spelled
        for content, i in special.items():
            self.bytes_of[i] = content.encode()
        self.special = special
        self.cut_special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.words = regex.compile(PATTERN)
        # merge of two ids: its rank and result; parts of each id
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.rank = np.full(n, -1, np.int64)
        self.left, self.right = np.arange(n), np.arange(n)
        for r, (a, b) in enumerate(merges):
            x, y, z = ids[a], ids[b], ids[a + b]
            self.merge.setdefault((x, y), (r, z))
            if self.rank[z] < 0 and self.left[z] == z:
                self.rank[z], self.left[z], self.right[z] = r, x, y
        pairs = np.array([x * n + y for x, y in self.merge], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.n = pairs[order], n
        self.pair_rank = np.array([r for r, _ in self.merge.values()], np.int64)[order]
        made = np.flatnonzero(self.rank >= 0)
        self.sound = np.ones(n, bool)
        self.sound[made] = self.stands(self.left[made], self.right[made], self.rank[made])
        for z in made[np.argsort(self.rank[made])]:
            self.sound[z] &= self.sound[self.left[z]] and self.sound[self.right[z]]
        # every beginning of a token: its id, or -1 where it is none itself
        self.starts = {t[:k]: -1 for t in self.id_of for k in range(1, len(t))} | self.id_of
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def cross(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of ``a`` and ``b``, or NONE."""
        key = a * self.n + b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_rank[at], NONE)

    def stands(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether merging the bytes of ``a`` and ``b`` leaves just these two ids.

        Undoes the merges from the last back. No merge across the border may come before the
        undone one; of equal ranks the left place comes first.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        ok = np.ones(len(a), bool)
        limit = np.full(len(a), NONE) if limit is None else limit.copy()
        open_ = np.arange(len(a))
        while len(open_):
            x, y = a[open_], b[open_]
            bad = self.cross(x, y) < limit[open_]
            ok[open_[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            more = ~bad & (np.maximum(rx, ry) >= 0)
            open_, x, y, rx, ry = open_[more], x[more], y[more], rx[more], ry[more]
            undo_left = rx > ry
            limit[open_] = np.where(undo_left, rx, ry + 1)
            a[open_] = np.where(undo_left, self.right[x], x)
            b[open_] = np.where(undo_left, y, self.left[y])
        return ok

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        whole = self.id_of.get(word)
        if whole is not None:
            return [whole]
        out, at, n, look = [], 0, len(word), self.starts.get
        while at < n:
            end = best = at + 1
            found = token = look(word[at:end])
            while end < n:
                end += 1
                token = look(word[at:end])
                if token is None:
                    break
                if token >= 0:
                    best, found = end, token
            out.append(found)
            at = best
        return out

    def merge_short(self, word: bytes) -> list[int]:
        """Lowest rank first, leftmost first among equals, by scanning."""
        ids = [self.id_of[word[i : i + 1]] for i in range(len(word))]
        look, none = self.merge.get, (NONE_RANK, -1)
        steps = [look(pair, none) for pair in zip(ids, ids[1:])]
        while steps:
            best = min(steps)
            if best is none or best[0] == NONE_RANK:
                break
            i = steps.index(best)
            ids[i : i + 2] = [best[1]]
            del steps[i]
            if i:
                steps[i - 1] = look((ids[i - 1], ids[i]), none)
            if i < len(steps):
                steps[i] = look((ids[i], ids[i + 1]), none)
        return ids

    def merge_exactly(self, word: bytes) -> list[int]:
        """Lowest rank first, leftmost first among equals."""
        ids: list[int | None] = [self.id_of[word[i : i + 1]] for i in range(len(word))]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(ids) and (m := self.merge.get((ids[i], ids[after[i]]))):
                heapq.heappush(heap, (m[0], i, ids[i], ids[after[i]], m[1]))

        for i in range(len(ids) - 1):
            offer(i)
        while heap:
            _, i, x, y, z = heapq.heappop(heap)
            j = after[i]
            if ids[i] != x or j >= len(ids) or ids[j] != y:
                continue
            ids[i], ids[j] = z, None
            after[i] = after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [i for i in ids if i is not None]

    def learn(self, words: list[str]) -> None:
        """Encodes new words together and remembers them."""
        raw = [w.encode() for w in words]
        proposed = [self.propose(w) for w in raw]
        size = np.array([len(p) for p in proposed])
        flat = np.fromiter(chain.from_iterable(proposed), np.int64, int(size.sum()))
        owner = np.repeat(np.arange(len(words)), size)
        inner = owner[1:] == owner[:-1]
        a, b, of = flat[:-1][inner], flat[1:][inner], owner[1:][inner]
        distinct, back = np.unique(a * self.n + b, return_inverse=True)
        fails = np.zeros(len(words), bool)
        fails[of[~self.stands(distinct // self.n, distinct % self.n)[back]]] = True
        fails[owner[~self.sound[flat]]] = True
        for i, word in enumerate(words):
            self.known[word] = tuple(proposed[i] if not fails[i] else self.merge_short(raw[i]) if len(raw[i]) <= SHORT else self.merge_exactly(raw[i]))

    def forget(self) -> None:
        """Frees what a task has learned: workers go on to other operators."""
        self.known, self.older = {}, {}

    def recall(self, words: set[str]) -> None:
        """Makes these words known. Words not asked for in two fillings are forgotten."""
        new = words - self.known.keys()
        if len(self.known) + len(new) > REMEMBERED:
            self.older, self.known, new = self.known, {}, words
        for word in new & self.older.keys():
            self.known[word] = self.older[word]
        new -= self.known.keys()
        if new:
            self.learn(list(new))

    def encode(self, texts: list[str]) -> list[list[int]]:
        out = []
        for lo in range(0, len(texts), 512):
            cut = [self.parts(t) for t in texts[lo : lo + 512]]
            self.recall({w for text in cut for part in text if not isinstance(part, int) for w in part})
            for text in cut:
                ids: list[int] = []
                for part in text:
                    if isinstance(part, int):
                        ids.append(part)
                    else:
                        ids.extend(chain.from_iterable(map(self.known.__getitem__, part)))
                out.append(ids)
        return out

    def parts(self, text: str) -> list:
        """Words of the stretches between special tokens, and the ids of these."""
        words = PLAIN_PATTERN.findall if PLAIN_TEXT.fullmatch(text) else self.words.findall
        if not self.special or not any(s in text for s in self.special):
            return [words(text)]
        out, at = [], 0
        for m in self.cut_special.finditer(text):
            out += [words(text[at : m.start()]), self.special[m.group()]]
            at = m.end()
        return [*out, words(text[at:])]

    def decode(self, ids: list[int]) -> str:
        """Bytes of the ids, read as UTF-8; broken sequences become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_task(path: str):
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for piece in slices(batch):
                ids = vocab.encode([t or "" for t in piece.column(1).to_pylist()])
                flat = np.fromiter(chain.from_iterable(ids), np.int32)
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["doc_id", "ids"])
        vocab.forget()

    return task


def decode_task(path: str):
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                piece = batch.slice(lo, 1024)
                texts = [vocab.decode(ids.values.to_numpy(zero_copy_only=False).tolist() if ids.is_valid else []) for ids in piece.column(1)]
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    return task


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids)`` for every row. ``path`` names the vocabulary file, present on each worker."""
    return pick(docs, doc_id="doc_id", text="text").mapInArrow(freed(encode_task(path)), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids, decoded)`` for rows of ``(doc_id, ids)``. Null ids decode to an empty text."""
    return pick(encoded, doc_id="doc_id", ids="ids").mapInArrow(freed(decode_task(path)), "doc_id long, ids array<int>, decoded string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """The rows of ``decode(encode(docs))`` from one worker a task: with two, each holds the vocabulary, and stays beside later stages."""
    encoding, decoding = encode_task(path), decode_task(path)
    return pick(docs, doc_id="doc_id", text="text").mapInArrow(freed(lambda batches: decoding(encoding(batches))), "doc_id long, ids array<int>, decoded string")
