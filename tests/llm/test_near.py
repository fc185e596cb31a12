"""Near duplicates against all pairs; components against a plain search."""

import random

import numpy as np
import pytest
from tidemark.llm import near
from tidemark.llm.components import components
from tidemark.llm.queries import QUERIES


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def direct(rows, size, percent):
    sets = {d: shingles(t, size) for d, t in rows if d is not None}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def got(docs, size, percent=80):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near.near_duplicates(docs, size, percent).collect()}


def corpus(seed, copies=60):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 400)}" for _ in range(70)]
    rows = []
    for d in range(copies):
        words = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 10**6)}"
        rows.append((d + 1, " ".join(words)))
    rows += [(200, "a"), (201, "A"), (202, "a b"), (203, "b a"), (204, ""), (205, None), (206, "  \t\n"), (None, "a b"), (-3, "x " * 500), (-2, "x " * 700)]
    rows += [(300 + i, " ".join(f"v{rng.randint(0, 30)}" for _ in range(rng.randint(1, 9)))) for i in range(30)]
    rng.shuffle(rows)
    return rows


def test_links_of_short_texts(documents):
    rng, rows = random.Random(8), []
    for i in range(3000):
        words = [f"s{rng.randrange(10**9)}" for _ in range(6)]
        rows += [(2 * i, " ".join(words[:5])), (2 * i + 1, " ".join(words))]
    found = got(documents(rows), 2)
    assert all(found[2 * i] == (4, 2 * i) and found[2 * i + 1] == (5, 2 * i) for i in range(3000))


@pytest.mark.parametrize("size,crowded", [(2, 8), (2, 0), (5, 2)])
def test_all_pairs(documents, monkeypatch, size, crowded):
    monkeypatch.setattr(near, "CROWDED", crowded)
    rows = corpus(size + crowded)
    assert got(documents(rows), size) == direct(rows, size, 80)


def test_repeated_rows_and_empty_table(documents):
    found = near.near_duplicates(documents([(1, "a b c"), (1, "a b c"), (2, "a b c")]), 2).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in found) == [(1, 1), (1, 1), (2, 1)]
    assert near.near_duplicates(documents([])).count() == 0


def test_estimate_is_close():
    rng = np.random.default_rng(2)
    for n, share in ((60, 0.8), (5000, 0.8), (5000, 0.3)):
        pool = rng.integers(0, 2**63, 2 * n, dtype=np.uint64)
        common = int(2 * n * share / (1 + share))
        a, b = np.unique(pool[:n]), np.unique(pool[n - common : 2 * n - common])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        sig = [near.registers(x)[None] for x in (a, b)]
        assert abs(near.estimate(*sig, np.array([len(a)]), np.array([len(b)]))[0] - true) < 0.2


def test_leading_zeros():
    x = np.array([0, 1, 2**63, 2**64 - 1, 2**32, 12345], np.uint64)
    assert near.leading_zeros(x)[1:].tolist() == [64 - int(v).bit_length() for v in x[1:]]


def test_components(spark):
    edges = [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (8, 8), (7, 9), (5, 4), (None, 1)] + [(100 + i, 101 + i) for i in range(40)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {k: found[k] for k in (1, 2, 3, 4, 5, 7, 8, 9)} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 7: 7, 8: 7, 9: 7}
    assert {found[100 + i] for i in range(41)} == {100}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_query(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    expected = direct(rows, 2, 80)
    found = QUERIES["op5_near_dedup"](spark, sf).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)
