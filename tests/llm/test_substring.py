"""Repeated windows against a direct search."""

import hashlib
import random

import numpy as np
import pytest
from tidemark.llm import substring
from tidemark.llm.queries import QUERIES


def direct(rows, window):
    seen, out = set(), {}
    for doc, text in sorted((d, t or "") for d, t in rows if d is not None):
        words = text.encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if key in seen:
                gone[i : i + window] = [True] * window
            seen.add(key)
        out[doc] = (len(words), sum(gone), b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode())
    return out


def got(docs, window):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring.remove_repeats(docs, window).collect()}


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") * rng.randint(1, 2)
    shared = [[word() for _ in range(n)] for n in (24, 30, 61)]
    rows = []
    for d in range(60):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += [word() for _ in range(rng.randint(0, 25))]
            if rng.random() < 0.6:
                part = rng.choice(shared)
                a = rng.randint(0, 8)
                words += part[a:]
        rows.append((d * 7 % 60 + 1, " ".join(words)))
    rows += [(100, "r " * 200), (101, "p q " * 90), (102, ""), (103, None), (104, "p q " * 95), (None, "p q " * 50), (-5, "p q " * 20)]
    return rows


@pytest.mark.parametrize("crowded", [256, 0])
def test_direct_search(documents, monkeypatch, crowded):
    monkeypatch.setattr(substring, "CROWDED", crowded)
    rows = corpus(3)
    assert got(documents(rows), 20) == direct(rows, 20)


def test_blocks_do_not_matter(documents, monkeypatch):
    monkeypatch.setattr(substring, "BLOCK_ROWS", 10)
    rows = corpus(4)
    assert got(documents(rows), 20) == direct(rows, 20)


def test_repeated_row_keeps_its_text(documents):
    text = " ".join(map(str, range(40)))
    rows = substring.remove_repeats(documents([(1, text), (1, text), (2, text)])).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in rows) == [(1, 0), (1, 0), (2, 40)]
    assert substring.remove_repeats(documents([])).count() == 0


def test_index_finds_every_pattern():
    rng = np.random.default_rng(1)
    symbols = np.append(rng.integers(1, 6, 400), 0)
    index = substring.FMIndex(symbols, 6, 8)
    starts = np.arange(390)
    lo, hi = index.intervals(symbols, starts, 8)
    text = symbols.tolist()
    for s in starts:
        places = {i for i in range(394) if text[i : i + 8] == text[s : s + 8]}
        assert set(index.places[lo[s] : hi[s]].tolist()) == places


def test_query(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    expected = {d: (n, g, hashlib.sha256(k.encode()).hexdigest()) for d, (n, g, k) in direct(rows, 20).items()}
    found = QUERIES["op4_substring_dedup"](spark, sf).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found} == expected
