"""Ns-bounds clustering and packed hard negatives against plain Python integers."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmine.llm import clusters, negatives


def plain_clusters(rows, k, rounds, components, salt="2:"):
    """(id, cluster, squared distance) of each usable row, and the last centroids."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{salt}{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [list(z) for _, z in order[:k]]

    def nearest(z):
        far = [sum((a - b) ** 2 for a, b in zip(z, c)) for c in centroids]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        own = [nearest(z)[0] for _, z in kept]
        for c in range(len(centroids)):
            members = [z for (_, z), o in zip(kept, own) if o == c]
            if members:
                centroids[c] = [sum(col) // len(members) for col in zip(*members)]
    return [(i, *nearest(z)) for i, z in kept], centroids


def key(r):
    return (r[0] is None, *(x or 0 for x in r))


@pytest.mark.parametrize("copies", [1, 200])
def test_clusters_equal_an_exhaustive_search(spark, copies):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=6) * 0.2 + (i % 4))]) for i in range(240)]
    rows += [(1000 + i, rows[0][1]) for i in range(copies)]  # equal vectors
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    found = clusters.cluster(df, k=9, rounds=4, components=6)
    want, centroids = plain_clusters(rows, 9, 4, 6)
    assert sorted(tuple(r) for r in found.assigned.collect()) == sorted(want)
    assert found.centroids.tolist() == centroids
    assert found.evaluated[0] == len(rows) * 9
    assert all(e < len(rows) * 9 for e in found.evaluated[1:])  # bounds spare distances


def test_displacement_is_total_not_summed():
    """A centroid that went and came back has moved nowhere since the first round."""
    a, b = np.array([[0, 0]]), np.array([[30, 40]])
    assert clusters.displacements([a, b, a])[0, 0] == 0
    assert 50 <= clusters.displacements([a, b])[0, 0] < 50.001


def test_bounds_spare_what_they_may_and_no_more():
    rng = np.random.default_rng(5)
    z = rng.integers(-100, 100, size=(500, 8)) + 400 * rng.integers(0, 5, size=(500, 1))
    history = [z[:7].astype(np.int64)]
    state = None
    for _ in range(6):
        state, n = clusters.assign(z, state, history, clusters.displacements(history))
        state = state._replace(lower=state.lower.astype(np.float32))
        square = ((z[:, None, :] - history[-1][None]) ** 2).sum(axis=2)
        assert (state.cluster == square.argmin(axis=1)).all()
        history.append(np.array([z[state.cluster == c].sum(axis=0) // max(1, (state.cluster == c).sum())
                                 if (state.cluster == c).any() else history[-1][c] for c in range(7)]))
    assert n < 500 * 7 / 2


def test_clusters_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25], "x"), (1, [0.5, 0.25], "x"), (2, None, None), (3, [], "x"), (4, [0.5, None], "x"), (5, [nan, 0.0], "x"),
            (6, [inf, 0.0], "x"), (7, [1.0, 2.0, 3.0], "x"), (None, [9.0, -9.0], "x"), (8, [-0.001, 0.0], None), (9, [1e30, 0.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster string").withColumn("distance", F.lit("d"))
    found = clusters.cluster(df, k=3, rounds=2, components=2)
    want, centroids = plain_clusters([r[:2] for r in rows if r[0] != 9], 3, 2, 2)
    assert sorted((tuple(r) for r in found.assigned.collect()), key=key) == sorted(want, key=key)
    rows = clusters.with_inertia(found).collect()
    assert {r["inertia"] for r in rows} == {sum(w[2] for w in want)}
    for r in rows:
        assert r["cluster_inertia"] == sum(w[2] for w in want if w[1] == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()
    few = clusters.cluster(df.limit(2), k=40, rounds=5, components=2)
    assert few.assigned.count() == 2 and len(few.centroids) == 2
    none = clusters.cluster(df.limit(0), components=2)
    assert none.assigned.count() == 0 and clusters.with_inertia(none).count() == 0


# ---- hard negatives ------------------------------------------------------------------------


@pytest.mark.parametrize("size,rows,dims", [(3, 10, 4), (150, 501, 64), (10**6, 33, 16), (10**9, 7, 3), (0, 5, 2)])
def test_packed_products_are_exact(size, rows, dims):
    rng = np.random.default_rng(size)
    z, a = (rng.integers(-size, size + 1, size=(n, dims)) for n in (rows, 11))
    block = negatives.Packed(z, a)
    want = [[sum(int(x) * int(y) for x, y in zip(r, q)) for q in a] for r in z]
    assert block.scores(a).tolist() == want
    assert block.fields > 1


def test_fields_of_the_given_vectors(spark, sf):
    """Unit vectors of 64 components, scaled by 256: three rows to a machine word."""
    x = np.array([r["embedding"] for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()], dtype=np.float64)
    z = np.floor(256 * x).astype(np.int64)
    block = negatives.Packed(z, z[:5])
    assert block.fields == 3 and block.words.dtype == np.int64
    assert (block.scores(z[:5]) == z @ z[:5].T).all()


def plain_negatives(rows, every):
    kept = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows
            if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    lengths = [len(z) for _, _, z in kept]
    dims = max(set(lengths), key=lambda d: (lengths.count(d), d)) if kept else 0
    kept = [(i, label, z) for i, label, z in kept if len(z) == dims]
    out = []
    for anchor, label, a in {(i, label, tuple(z)) for i, label, z in kept if i % every == 0}:
        scored = sorted((-sum(x * y for x, y in zip(a, z)), i, other) for i, other, z in kept)
        for s, positive, _ in [r for r in scored if r[2] == label and r[1] != anchor][:5]:
            fits = [(n, i) for n, i, other in scored if other != label and 80 * -s <= 100 * -n <= 100 * -s][:5]
            out += [(anchor, positive, rank, i, -s, -n) for rank, (n, i) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(24, 8 << 20), (3, 400)])
def test_hard_negatives_equal_a_plain_search(spark, monkeypatch, blocks):
    monkeypatch.setattr(negatives, "LEAST_BLOCKS", blocks[0])
    monkeypatch.setattr(negatives, "BLOCK_BYTES", blocks[1])  # several parts of anchors
    monkeypatch.setattr(negatives, "SCORES", 64)
    rng = np.random.default_rng(8)
    base = rng.normal(size=5)
    rows = [(i, int(rng.integers(0, 3)), [float(x) for x in base + rng.normal(size=5) * (0.3 if i % 3 else 2)]) for i in range(150)]
    rows += [(300 + i, i % 2, rows[0][2]) for i in range(60)]  # one vector with over a quarter of the rows
    rows += [rows[10], rows[10], rows[11], (10, 2, rows[12][2])]  # repeats, and an id with two labels
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(4)
    found = negatives.hard_negatives(df, F.col("id") % 10 == 0)
    got = sorted(tuple(r) for r in found.collect())
    assert got == plain_negatives(rows, 10) and len(got) > 50


def test_hard_negatives_of_odd_rows(spark):
    nan = float("nan")
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [0.9, 0.1]), (2, 2, [0.85, 0.3]), (3, None, [1.0, 0.0]), (4, 2, None), (5, 2, [None, 1.0]),
            (6, 2, [nan, 1.0]), (7, 2, []), (8, 2, [1.0, 0.0, 0.0]), (None, 2, [0.85, 0.1]), (10, 3, [-1.0, 0.0]), (20, 2, [1e30, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumns(
        {c: F.lit("x") for c in ("id", "z", "key", "score", "rank", "block", "part")})
    got = sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("id") % 10 == 0).collect())
    assert got == plain_negatives(rows[:-1], 10) and got
    assert negatives.hard_negatives(df.limit(0), F.col("id") % 10 == 0).count() == 0
    assert negatives.hard_negatives(df.limit(1), F.col("id") % 10 == 0).count() == 0
