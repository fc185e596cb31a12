"""Clustering against plain loops over exact integers."""

import hashlib
import math

import numpy as np
import pytest

from tidemark.llm import pivots


def plainly(rows, k=16, rounds=3, dims=64, scale=64, seed=1):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), p) for i, p in kept)[:k]
    centres = [p for _, p in first]

    def near(p):
        return min((sum((a - b) ** 2 for a, b in zip(p, c, strict=True)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        own = [near(p)[1] for _, p in kept]
        for n in range(len(centres)):
            held = [p for (_, p), c in zip(kept, own, strict=True) if c == n]
            if held:
                centres[n] = [sum(x) // len(held) for x in zip(*held, strict=True)]
    last = [(i, *near(p)) for i, p in kept]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    by = {n: sum(d for _, d, c in last if c == n) for n in range(len(centres))}
    return sorted(((i, n, d, by[n], sum(by.values()), sha[n]) for i, d, n in last), key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, point int, cached string").repartition(3)
    out = pivots.cluster(df, **kw).drop("n_measured")
    return sorted(map(tuple, out.collect()), key=str)


def test_groups_ties_and_rows_that_take_no_part(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8)) * 4
    rows = [(i, (centres[i % 6] + rng.normal(size=8) * 0.2).tolist()) for i in range(300)]
    rows += [(1000 + i, [0.5] * 8) for i in range(40)] + [(i, v) for i, v in rows[:5]] + [(None, [1.0] * 8)]
    odd = [(2000, None), (2001, []), (2002, [1.0] * 7), (2003, [1.0] * 7 + [None]), (2004, [float("nan")] * 8), (2005, [float("-inf")] * 8)]
    assert run(spark, rows + odd, dims=8, k=10) == plainly(rows + odd, dims=8, k=10)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5])
def test_fewer_vectors_than_centroids(spark, n):
    rows = [(i, [float(i), -1.0, 0.3]) for i in range(n)]
    assert run(spark, rows, dims=3) == plainly(rows, dims=3)


def test_equal_vectors_only(spark):
    rows = [(i, [0.25, -0.75]) for i in range(50)]
    got = run(spark, rows, dims=2)
    assert got == plainly(rows, dims=2) and {r[1] for r in got} == {0}


def test_lattice_ties_go_to_the_smaller_number(spark):
    rows = [(i, [i % 5 / 64, i // 5 % 5 / 64]) for i in range(75)]
    assert run(spark, rows, dims=2, k=7) == plainly(rows, dims=2, k=7)


def test_large_components_are_exact_and_larger_ones_refused(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.choice([-1, 1], 4) * (2.0**21 - rng.integers(0, 3, 4))).tolist()) for i in range(60)]
    assert run(spark, rows, dims=4, k=5) == plainly(rows, dims=4, k=5)
    with pytest.raises(Exception, match="too large"):
        run(spark, [*rows, (99, [3e6, 0.0, 0.0, 0.0])], dims=4)


def test_bounds_are_below_distances_and_save_work():
    rng = np.random.default_rng(4)
    centres = rng.integers(-900, 900, (16, 32))
    points = centres[rng.integers(0, 16, 4000)] + rng.integers(-40, 40, (4000, 32))
    p = pivots.Pivots(points[:16])
    low = p.bounds(pivots.distances(points, p.points), centres)
    true = ((points[:, None] - centres[None]) ** 2).sum(-1)
    assert (low <= true).all()
    best, least, measured = pivots.nearest(points, pivots.distances(points, p.points), centres, p)
    assert (least == true.min(1)).all() and (best == true.argmin(1)).all()
    assert measured.mean() < 8  # of 16


def test_bounds_at_extreme_sizes():
    rng = np.random.default_rng(5)
    for size in (3, 1 << 27):
        points = rng.integers(-size, size, (500, 6))
        p = pivots.Pivots(points[:9])
        best, least, _ = pivots.nearest(points, pivots.distances(points, p.points), points[20:40], p)
        true = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, c, strict=True)) for c in points[20:40]] for x in points]
        assert least.tolist() == [min(t) for t in true] and best.tolist() == [t.index(min(t)) for t in true]


def test_query_on_the_given_table(spark, sf):
    from tidemark.llm.queries import QUERIES

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, QUERIES["op12_centroid_clusters"](spark, sf).collect()), key=str) == plainly(rows)
