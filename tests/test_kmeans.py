"""K-means: the six-point golden case, exact distances and points that have no centroid."""

import pytest

from sparkmine.operators import kmeans as K


def _points(spark):
    pts = [(1, 2), (1, 4), (1, 0), (10, 2), (10, 4), (10, 0)]
    return spark.createDataFrame([(i, [float(a), float(b)]) for i, (a, b) in enumerate(pts)],
                                 "vec_id long, v array<double>")


def test_six_point_golden(spark):
    cents, rounds, converged = K.fit(_points(spark), init=[(0, [1.0, 2.0]), (1, [10.0, 2.0])])
    assert sorted(tuple(v) for _, v in cents) == [(1.0, 2.0), (10.0, 2.0)]
    assert rounds == 1 and converged


def test_rounds_run_out_before_convergence(spark):
    start = [(0, [1.0, 0.0]), (1, [1.0, 2.0])]
    assert not K.fit(_points(spark), init=start, max_iter=1).converged
    assert K.fit(_points(spark), init=start).converged


def test_tie_goes_to_lowest_id(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0])], "vec_id long, v array<double>")
    r = K.assign(df, [(1, [-1.0, 0.0]), (0, [1.0, 0.0])]).first()
    assert r.cid == 0


def test_small_distances_are_compared_exactly(spark):
    df = spark.createDataFrame([(0, [3e-5])], "vec_id long, v array<double>")
    r = K.assign(df, [(0, [1e-5]), (1, [3e-5])]).first()
    assert (r.cid, r.dist) == (1, 0.0)


@pytest.mark.parametrize("at_once", [4096, 2])
def test_points_without_a_centroid(spark, monkeypatch, at_once):
    monkeypatch.setattr(K, "ROWS_AT_ONCE", at_once)
    rows = [(0, None), (1, [1.0]), (2, [1.0, None]), (3, [float("nan"), 0.0]), (4, [1.0, 2.0]), (5, [9.0, 9.0]), (6, [1.0, 2.0]), (7, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>").withColumnRenamed("vec_id", "cid").selectExpr("cid as vec_id", "v", "1 as dist")
    init = [(0, [1.0, 1.0]), (1, [9.0, 9.0])]
    found = {r.vec_id: (r.cid, r.dist) for r in K.assign(df, init).collect()}
    assert found == {0: (None, None), 1: (None, None), 2: (None, None), 3: (None, None), 4: (0, 1.0), 5: (1, 0.0), 6: (0, 1.0), 7: (None, None)}
    expected = [(0, [1.0, 2.0]), (1, [9.0, 9.0])]
    assert K._collect_centroids(K.step(df, init)) == K._collect_centroids(K.update(K.assign(df, init))) == expected


def test_no_points(spark):
    df = _points(spark).limit(0)
    assert K.fit(df, k=2) == ([], 0, True)
    assert K.step(df, [(0, [1.0, 2.0])]).count() == 0
    with pytest.raises(ValueError, match="no centroids"):
        K.assign(df, [])


def test_empty_cluster_disappears(spark):
    cents = K.fit(_points(spark), init=[(0, [1.0, 2.0]), (1, [100.0, 100.0])], max_iter=1).centroids
    assert [c for c, _ in cents] == [0]


def test_seeded_initial_centroids_repeatable(spark):
    pts = _points(spark)
    a = K.initial_centroids(pts, 3, seed=7)
    b = K.initial_centroids(pts, 3, seed=7)
    assert a == b and len({tuple(v) for _, v in a}) == 3
    assert [c for c, _ in K.initial_centroids(pts, 2)] == [0, 1]


def test_infinite_points_belong_to_no_cluster(spark):
    inf = float("inf")
    rows = [(0, [inf, 0.0]), (1, [1.0, 2.0]), (2, [1.0, 4.0]), (3, [9.0, 9.0]), (4, [-inf, 1.0]), (5, None), (6, [None, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>")
    fit = K.fit(df, k=2)
    assert fit.converged and sorted(c for _, c in fit.centroids) == [[1.0, 3.0], [9.0, 9.0]]
    own = {r.vec_id: r.cid for r in K.assign(df, fit.centroids).collect()}
    assert [i for i, c in own.items() if c is None] == [0, 4, 5, 6]
