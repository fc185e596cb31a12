"""Greedy string tiling against a plain form of it."""

import random

import numpy as np
from tidemark.llm import tiling
from tidemark.llm.queries import QUERIES


def plain_tiles(item, doc, tile):
    a, b = [False] * len(item), [False] * len(doc)
    out = []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not a[i + n] and not b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < max(tile, 1):
            return out
        a[i : i + n] = [True] * n
        b[j : j + n] = [True] * n
        out.append(best)


def test_tiles():
    rng = random.Random(1)
    for _ in range(200):
        item = [rng.randint(0, 4) for _ in range(rng.randint(1, 18))]
        doc = [rng.randint(0, 4) for _ in range(rng.randint(1, 40))]
        tile = min(rng.randint(1, 4), len(item))
        mine = tiling.tiles(np.array(item, np.uint64), np.array(doc, np.uint64), tile)
        assert mine == plain_tiles(item, doc, tile)
        repeats = tiling.tiles_in_repeats(np.array(item, np.uint64), np.array(doc, np.uint64), tile)
        assert repeats == mine


def test_repetitive_texts_in_little_memory():
    """Equal words by the thousand: the pairs of equal windows would take gigabytes."""
    import tracemalloc

    item, doc = np.full(2000, 7, np.uint64), np.full(200_000, 7, np.uint64)
    assert tiling.pair_count(item, doc, 5) > 10**8
    tracemalloc.start()
    assert tiling.tiles(item, doc, 5) == [(2000, 0, 0)]
    mixed = np.tile(np.arange(1, 4, dtype=np.uint64), 400)
    found = tiling.tiles(np.append(mixed, np.uint64(9)), np.concatenate([mixed[:600], [np.uint64(8)], np.tile(mixed, 50)]), 5)
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()
    assert found == [(1200, 0, 601)]


def test_repetitive_documents_and_repeated_items(documents, spark):
    word, other = "spam " * 400_000, "spam ham " * 30_000
    docs = documents([(1, word), (2, other), (3, "clean words only here now")])
    bench = spark.createDataFrame([(1, "spam " * 2000)] * 3 + [(2, "ham spam " * 500), (3, None)], "item_id long, text string")
    found = sorted((r.doc_id, r.item_id, r.covered) for r in tiling.leaks(docs, bench).collect())
    assert found == [(1, 1, 2000)] * 3 + [(2, 2, 1000)]
    many = spark.range(100_000).selectExpr("7L AS item_id", "'one item given very often in the test set' AS text")
    again = documents([(4, "so one item given very often in the test set"), (5, "nothing")])
    blocks = list(tiling.blocks(many, 1000))
    assert len(blocks) == 1 and blocks[0] == [(7, "one item given very often in the test set", 100_000)]
    assert tiling.leaks(again, many).count() == 100_000
    assert [r.doc_id for r in tiling.decontaminate(again, many).collect()] == [5]


def direct(docs, items, tile=5, coverage=0.5):
    out = set()
    for d, text in docs:
        words = (text or "").encode().lower().split()
        for k, item in items:
            own = (item or "").encode().lower().split()
            if own:
                covered = sum(n for n, _, _ in plain_tiles(own, words, min(tile, len(own))))
                if covered >= coverage * len(own):
                    out.add((d, k, covered))
    return out


ITEM = "the quick brown fox jumps over the lazy dog while twenty seven green bottles stand on a wall"
MOVED = " ".join([*ITEM.split()[9:], "and", "then", *ITEM.split()[:9]])


def test_leaks_and_filter(documents, spark):
    docs = [(1, "so " + ITEM.upper() + " end"), (2, MOVED), (3, " ".join(ITEM.split()[:7])), (4, None), (5, ""), (6, "short test"), (None, ITEM), (1, ITEM), (7, "w " * 60_000 + ITEM)]
    items = [(1, ITEM), (2, "short test"), (3, None), (4, ""), (1, ITEM)]
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    small = [d for d in docs if d[0] != 7]
    for words in (1_000_000, 4):
        found = tiling.leaks(documents(docs), bench, block_words=words).collect()
        assert {(r["doc_id"], r["item_id"], r["covered"]) for r in found if r["doc_id"] != 7} == direct(small, items)
        assert (7, 1) in {(r["doc_id"], r["item_id"]) for r in found}
        kept = tiling.decontaminate(documents(docs), bench, block_words=words)
        assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5]
        assert kept.columns == documents(docs).columns
    assert tiling.leaks(documents(docs), bench.limit(0)).count() == 0
    assert tiling.leaks(documents([]), bench).count() == 0
    assert tiling.decontaminate(documents(docs), bench.limit(0)).count() == len(docs)


def test_query(spark, sf):
    """Verbatim items are found; every leak holds half of its item in runs of five words."""
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    found = {(r["doc_id"], r["item_id"]) for r in QUERIES["op9_decontaminate"](spark, sf).collect()}
    assert found >= {(d, i) for d, t in docs.items() for i, item in items.items() if " ".join(item.split()) in " ".join(t.split())}
    runs = lambda t: {tuple(w[i : i + 5]) for w in [t.lower().split()] for i in range(len(w) - 4)}
    near = [(d, i) for d, t in docs.items() for own in [runs(t)] for i, item in items.items() if own & runs(item)]
    assert found == {(d, i) for d, i, _ in direct_of(near, docs, items)}


def direct_of(pairs, docs, items):
    return {hit for d, i in pairs for hit in direct([(d, docs[d])], [(i, items[i])])}
