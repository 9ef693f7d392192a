"""Exact top-k and the permutation index against brute force."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkmine.llm import blocks, permutation, vafile


@pytest.fixture(scope="module")
def vectors(spark, sf):
    return spark.read.parquet(f"{sf}/embeddings.parquet")


@pytest.fixture(scope="module")
def matrix(vectors):
    rows = vectors.orderBy("vec_id").collect()
    return np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=np.float64)


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def plain_top_k(ids, x, every, k):
    z = np.floor(256 * x).astype(np.int64)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        scores = z @ z[i]
        order = [j for j in np.lexsort((ids, -scores)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), int(scores[j])) for j in order]
    return out


def test_top_k_is_exact(vectors, matrix):
    found = vafile.top_k(vectors, F.col("id") % 50 == 0).collect()
    assert by_query(found) == plain_top_k(*matrix, 50, 5)


def measured_recall(ids, x, found, every, queries):
    """Recall of ``found`` against brute force, whose scores it must have."""
    hits = total = 0
    for i in np.flatnonzero(ids % every == 0):
        far = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        best = [j for j in np.lexsort((ids, far)) if j != i][:10]
        own = found[int(ids[i])]
        assert len(own) == 10 and own == sorted(own, key=lambda v: (v[1], v[0]))
        assert all(math.isclose(s, far[np.flatnonzero(ids == v)[0]], rel_tol=1e-12) for v, s in own)
        hits += len({int(ids[j]) for j in best} & {v for v, _ in own})
        total += 10
    assert total == 10 * queries
    print(f"recall {hits / total:.4f} of {total}")
    return hits / total


def test_nearest_reaches_its_recall(vectors, matrix):
    found = by_query(permutation.nearest(vectors, F.col("id") % 20 == 0).collect())
    assert measured_recall(*matrix, found, 20, 25) >= 0.9


@pytest.mark.parametrize("folder, every, queries", [("sf0.1", 20, 100), (None, 200, 100)])
def test_recall_of_larger_tables(spark, folder, every, queries):
    """2,000 vectors of the tables and 20,000 without any structure, with the same parameters."""
    if folder:
        df = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet")
        rows = df.orderBy("vec_id").collect()
        ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=np.float64)
    else:
        ids, x = np.arange(20_000), np.random.default_rng(4).standard_normal((20_000, 64))
        df = spark.createDataFrame(pd.DataFrame({"vec_id": ids, "embedding": x.tolist()}))
    found = by_query(permutation.nearest(df, F.col("id") % every == 0).collect())
    assert measured_recall(ids, x, found, every, queries) >= 0.9


def test_vectors_read_grow_slower_than_the_table():
    reads = [permutation.read_per_query(n) for n in (500, 2_000, 20_000, 2_000_000)]
    assert reads == [269, 537, 1698, 16971]
    assert permutation.read_per_query(50) == 50 and permutation.read_per_query(0) == 0


def test_a_query_reads_its_share_of_a_part_and_no_more():
    rng = np.random.default_rng(8)
    x, pivots = rng.standard_normal((200, 6)), rng.standard_normal((20, 6))
    files = permutation.inverted_files(permutation.nearest_pivots(x, pivots, 7), 20)
    rows = [(p, r.astype("<i4").tobytes(), w.astype("<u2").tobytes()) for p, (r, w) in enumerate(files)]
    rows += [(permutation.VECTORS, b"", x.tobytes()), (permutation.IDS, np.arange(200, dtype="<i4").tobytes(), np.arange(200).tobytes())]
    part = pd.DataFrame(rows, columns=["pivot", "rows", "values"])
    asking = pd.DataFrame({"key": [0], "query_id": [3], "v": [x[3]], "order": [permutation.nearest_pivots(x[3:4], pivots, 7)[0]]})
    assert len(permutation.search_part(part, asking, k=50, read=20)) == 20
    whole = permutation.search_part(part, asking, k=5, read=200)
    far = np.sqrt(((x - x[3]) ** 2).sum(axis=1))
    assert whole["vec_id"].tolist() == np.argsort(far)[1:6].tolist()


def test_copies_of_one_vector_leave_room_for_others(spark):
    """A third of all rows is one vector: a query beside it still finds its true neighbours."""
    rng = np.random.default_rng(6)
    x = rng.standard_normal((900, 8))
    x[::3] = 0.05
    ids = np.arange(900)
    df = spark.createDataFrame(pd.DataFrame({"vec_id": ids, "embedding": x.tolist()}))
    found = by_query(permutation.nearest(df, F.col("id") % 50 == 1).collect())
    for i in np.flatnonzero(ids % 50 == 1):
        far = ((x - x[i]) ** 2).sum(axis=1)
        best = [int(j) for j in np.lexsort((ids, far)) if j != i][:10]
        assert len(set(best) & {v for v, _ in found[i]}) >= 9
    kept = permutation.distinct_vectors(df.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")), 10).collect()
    assert len(kept) == 601 and max(len(r["ids"]) for r in kept) == 11


def test_the_index_holds_every_vector_once(spark, vectors, matrix):
    ids, x = matrix
    fine = permutation.distinct_vectors(blocks.valid_vectors(vectors, "vec_id", "embedding"), 10)
    pivots = permutation.choose_pivots(fine, 30)
    index = permutation.build(fine, pivots, 8, 7)
    posted = index.filter("pivot >= 0").agg(F.sum(F.octet_length("rows") / 4), F.max("pivot"), F.countDistinct("part")).first()
    assert posted[0] == 8 * len(np.unique(x, axis=0)) and posted[1] < 30 and posted[2] == 7
    assert index.filter(F.col("pivot") == permutation.IDS).agg(F.sum(F.octet_length("values") / 8)).first()[0] == len(ids)


def test_footrule_is_that_of_the_definition():
    rng = np.random.default_rng(1)
    orders = np.array([rng.permutation(12)[:5] for _ in range(40)])
    files = dict(enumerate(permutation.inverted_files(orders, 12)))
    for q in orders[:7]:
        found = permutation.footrule(q, files, len(orders))
        for v, distance in zip(orders, found):
            place = [{p: i for i, p in enumerate(o)} for o in (q, v)]
            assert distance == sum(abs(place[0].get(p, 5) - place[1].get(p, 5)) for p in range(12))


def test_bounds_hold_and_reading_stops_early():
    rng = np.random.default_rng(2)
    x, q = np.floor(rng.standard_normal((300, 9)) * 256), np.floor(rng.standard_normal((4, 9)) * 256)
    codes, edges = vafile.approximate(x)
    assert (vafile.upper_bounds(q, codes, edges) >= q @ x.T).all()


@pytest.mark.parametrize("search", [vafile.top_k, permutation.nearest])
def test_odd_vectors(spark, search):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (100, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]),
            (5, [inf, 1.0]), (None, [1.0, 2.0]), (6, [0.5]), (7, []), (8, [0.0, 0.0]), (9, [-3.0, 5.0])]
    df = spark.createDataFrame([(i, v, 3, "x") for i, v in rows], "vec_id long, embedding array<float>, score int, block string")
    found = by_query(search(df, F.col("id") % 100 == 0).collect())
    zero = set() if search is permutation.nearest else {8}
    assert set(found) == {0, 100}
    assert {v for v, _ in found[0]} == {100, 1, 9} | zero and {v for v, _ in found[100]} == {0, 1, 9} | zero
    assert search(df, F.col("id") == 55).count() == 0
    assert search(df.limit(0), F.col("id") % 100 == 0).count() == 0


def test_huge_components_are_summed_as_whole_numbers(spark):
    rows = [(0, [3.0e9, 1.0]), (1, [3.0e9, 1.0]), (2, [3.0e9, 2.0]), (3, [1e30, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = by_query(vafile.top_k(df, F.col("id") == 0, scale=1).collect())
    assert found[0] == [(3, 2**63 - 1), (2, 9 * 10**18 + 2), (1, 9 * 10**18 + 1)]


def test_one_id_with_several_vectors_is_several_queries_of_that_id(spark):
    df = spark.createDataFrame([(0, [1.0]), (0, [2.0]), (1, [1.0])], "vec_id long, embedding array<float>")
    rows = vafile.top_k(df, F.col("id") == 0).collect()
    assert sorted((r["vec_id"], r["score"]) for r in rows) == [(1, 65536), (1, 131072)]


@pytest.mark.parametrize("search", [vafile.top_k, permutation.nearest])
def test_each_repeated_row_takes_a_rank(spark, search):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.0]), (3, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = search(df, F.col("id") == 0, k=3).collect()
    assert sorted((r["rank"], r["vec_id"]) for r in found) == [(1, 1), (2, 1), (3, 2)]


def test_blocks_grow_with_the_table(vectors, monkeypatch):
    expected = by_query(vafile.top_k(vectors, F.col("id") % 100 == 0).collect())
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 2048)  # several query blocks as well
    assert by_query(vafile.top_k(vectors, F.col("id") % 100 == 0).collect()) == expected
