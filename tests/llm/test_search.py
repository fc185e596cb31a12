"""Nearest neighbours, license scans and archives."""

import hashlib

import numpy as np
import pytest
from tidemark.llm import ann, licenses, warc
from tidemark.llm.common import shared_dir
from tidemark.llm.queries import ORACLES, QUERIES


# --- nearest -----------------------------------------------------------------------
def exact(vectors, queries, k):
    out = {}
    for q, v in queries:
        scored = sorted((-float((np.array(v) * np.array(x)).sum()), i) for i, x in vectors if i != q)
        out[q] = [i for _, i in scored[:k]]
    return out


def test_graph_recall():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = ann.build(x.astype(np.float32), 1)
    hits = [len({*graph.query(x[i].astype(np.float32), 64)[:20]} & {*np.argsort(-(x @ x[i]))[:20]}) for i in range(0, 3000, 30)]
    assert np.mean(hits) / 20 > 0.95


@pytest.mark.parametrize("rows", [1000, 60])
def test_small_tables_are_exact(spark, rows):
    rng = np.random.default_rng(2)
    good = [(i, [float(v) for v in rng.integers(-3, 4, 4)]) for i in range(120)]
    good = [(i, v) for i, v in good if any(v)] + [(500 + i, [1.0, 2.0, 3.0, 3.0]) for i in range(80)]
    bad = [(900, None), (901, [0.0] * 4), (902, [1.0, None, 1.0, 1.0]), (903, [1.0, float("nan"), 0.0, 0.0]), (904, [float("inf")] * 4), (None, [1.0] * 4), (905, []), (906, [1.0, 2.0])]
    table = spark.createDataFrame([(i, v, 0, "x") for i, v in [*good, *bad, good[0]]], "vec_id long, embedding array<double>, label int, v string")
    found = {}
    for r in ann.nearest(table, table.where("vec_id % 20 = 0"), 20, shard_rows=rows).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    expected = exact(good, [(i, v) for i, v in good if i % 20 == 0], 20)
    assert {q: [x[k] for k in sorted(x)] for q, x in found.items()} == expected
    assert ann.nearest(table.limit(0), table.limit(0)).count() == 0


def recall(spark, x, shard_rows=8192, step=20):
    """Share of the true neighbours found, by products that neither overflow nor vanish."""
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {}
    for r in ann.nearest(table, table.where(f"vec_id % {step} = 0"), 20, shard_rows=shard_rows).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    near = np.ldexp(x, -int(np.frexp(np.abs(x).max())[1]))
    hits = 0
    for q, own in found.items():
        score = near @ np.ldexp(x[q], -int(np.frexp(np.abs(x[q]).max())[1]))
        score[q] = -np.inf
        hits += len({*own.values()} & {*np.argsort(-score, kind="stable")[:20].tolist()})
    assert len(found) == len(range(0, len(x), step)) and all(sorted(own) == list(range(1, 21)) for own in found.values())
    return hits / 20 / len(found)


@pytest.mark.parametrize("kind", ["one long vector", "twelve decades", "1e160", "1e-170"])
def test_recall_at_any_norm(spark, kind):
    x = np.random.default_rng(6).normal(size=(2500, 24))
    if kind == "one long vector":
        x[17] *= 1e4
    elif kind == "twelve decades":
        x *= 10 ** np.random.default_rng(7).uniform(-6, 6, (2500, 1))
    else:
        x *= float(kind)
    assert recall(spark, x) >= 0.95


def test_recall_over_two_dozen_shards(spark):
    x = np.random.default_rng(8).normal(size=(6000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert recall(spark, x.astype(np.float32).astype(np.float64), shard_rows=240, step=60) >= 0.95


def test_every_shard_is_searched_alike(spark, monkeypatch):
    widths, search = [], ann.search_shard
    monkeypatch.setattr(ann, "search_shard", lambda k, ef, top=0: widths.append(ef) or search(k, ef, top))
    x = np.random.default_rng(4).normal(size=(3000, 64))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    queries = table.where("vec_id % 50 = 0")
    found = {}
    for r in ann.nearest(table, queries, 20, shard_rows=700).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    ann.nearest(table, queries, 20)
    assert widths == [ann.EF] * 2  # five shards and one
    hits = 0
    for q, own in found.items():
        score = x @ x[q]
        score[q] = -np.inf
        hits += len(own & {*np.argsort(-score)[:20].tolist()})
    assert len(found) == 60 and hits / 1200 >= 0.98


def test_nearest_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    found = {}
    for r in QUERIES["op7_nearest_vectors"](spark, sf).collect():
        found.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        score = x @ x[q]
        best = [j for j in np.lexsort((ids, -score)) if j != q][:20]
        own = found[ids[q]]
        hits, total = hits + len({*ids[best].tolist()} & own.keys()), total + 20
        assert all(abs(own[i] - score[np.flatnonzero(ids == i)[0]]) < 1e-12 for i in own)
    assert hits / total >= 0.95


# --- licenses ----------------------------------------------------------------------
def test_licenses(documents):
    mit, notice = licenses.TEMPLATES["mit"], licenses.TEMPLATES["mit-notice"]
    words = mit.split()
    rows = [
        (1, f"intro {notice} more"), (2, notice.upper()), (3, "released under some license"), (4, None), (5, ""), (6, "é " * 500 + mit + " tail " * 700), (7, " ".join(words[: len(words) // 2])),
        (8, " ".join(w if i % 40 else "changed" for i, w in enumerate(words, 1))), (1, f"intro {notice} more"), (None, notice), (9, "x" * 200_000), (10, (notice + " filler words here ") * 50),
    ]
    found = {(r["doc_id"], r["license"]): r for r in licenses.scan(documents(rows)).collect()}
    assert set(found) == {(1, "mit-notice"), (2, "mit-notice"), (6, "mit"), (8, "mit"), (None, "mit-notice"), (10, "mit-notice")}
    assert found[6, "mit"]["containment"] == 1.0 and 0.8 <= found[8, "mit"]["containment"] < 1
    assert licenses.scan(documents([])).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(documents(rows), {"x": "single"})


def test_license_plan_is_native(spark, sf):
    plan = QUERIES["op2_license_scan"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop") if w in plan]


def test_license_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = {(r["doc_id"], r["license"]) for r in QUERIES["op2_license_scan"](spark, sf).collect()}
    assert found >= {(d, k) for d, t in docs.items() for k, v in licenses.TEMPLATES.items() if v in t}

    def pairs(text):
        w = [x for x in __import__("re").split("[^a-z0-9\x80-\U0010ffff]+", text.lower()) if x]
        return list(zip(w, w[1:], strict=False))

    whole = {k: set(pairs(v)) for k, v in licenses.TEMPLATES.items()}
    assert all(len(whole[k] & set(pairs(docs[d]))) >= 0.8 * len(whole[k]) for d, k in found)


# --- archives ----------------------------------------------------------------------
BIG = "<p>é" + "x" * 1200


def test_archives(spark):
    rows = [(1, "http://a/é b\r\nX: y", BIG), (2, None, BIG), (3, "u", "small"), (4, "u", "small"), (5, "u", None), (6, "u", ""), (7, "u", BIG + "y"), (None, "u", BIG), (2, None, BIG), (8, "u", "z" * 300_000), (9, "u", "\r\n\r\nWARC/1.1")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string").repartition(3)
    folder = shared_dir(spark)
    archives = warc.write_archives(pages, folder, archive_bytes=500)
    assert archives.agg({"records": "sum"}).first()[0] == len(rows)
    back = warc.read_archives(archives, folder).collect()
    assert len(back) == len(rows)
    for r in back:
        assert r["record_type"] == ("revisit" if r["page_id"] in (1, None) else "response")
        assert r["refers_to"] == (2 if r["record_type"] == "revisit" else None)
        if r["record_type"] == "response":
            text = next(h or "" for i, _, h in rows if i == r["page_id"])
            assert r["payload"] == text.encode() and r["payload_digest"] == hashlib.sha1(text.encode()).hexdigest()
        else:
            assert r["payload"] is None and r["payload_bytes"] == len(BIG.encode())
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_damaged_payload_is_noticed():
    import io

    good = warc.record(1, "u", b"hello", 5, hashlib.sha1(b"hello").hexdigest(), "response", None, "1970-01-01T00:00:00Z")
    assert [r[0] for r in warc.records_of(io.BufferedReader(io.BytesIO(good)))] == [1]
    with pytest.raises(ValueError):
        list(warc.records_of(io.BufferedReader(io.BytesIO(good.replace(b"hello", b"hallo")))))


def test_archive_query(spark, sf):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    expected = con.execute(ORACLES["op10_warc_archives"]).fetchall()
    columns = [d[0] for d in con.description]
    assert sorted(tuple(r[c] for c in columns) for r in QUERIES["op10_warc_archives"](spark, sf).collect()) == sorted(expected)


def test_nodes_are_expanded_and_linked_many_at_once(monkeypatch):
    """A search takes few steps, a build no search at all, and neighbours before a node are exact."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 24)).astype(np.float32)
    x[700:720] = x[3]
    steps, near, search = [], ann.Graph.near, ann.Graph.search
    monkeypatch.setattr(ann.Graph, "search", None)
    graph = ann.build(x, 2)
    monkeypatch.setattr(ann.Graph, "search", search)
    monkeypatch.setattr(ann.Graph, "near", lambda self, layer, nodes: steps.append(layer) or near(self, layer, nodes))
    found = graph.query(x[9], 160)
    assert len({*found.tolist()}) == 160 and steps.count(0) <= 25
    for row, nodes, close in ann.nearest_before(x, np.arange(0, 1500, 2)):
        before = x[np.arange(0, 2 * row, 2)] @ x[2 * row]
        assert len(nodes) == min(row, ann.EF_BUILD) and np.allclose(np.sort(close), np.sort(before)[-len(nodes) :], atol=1e-3)
