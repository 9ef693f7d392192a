"""Approximate nearest neighbours with a permutation index.

A vector is represented by the order in which it meets a fixed set of pivots: its
``prefix`` nearest pivots, nearest first. Vectors are posted in the inverted files of
these pivots with the place they give them. A query reads the files of its own nearest
pivots and sums up how well the places agree, which is the footrule distance of the two
orders (a pivot beyond the prefix counts as at its end). The vectors that are nearest by
footrule are then ranked by exact Euclidean distance.

The index is a table in the shared folder (``build``): vectors are dealt to parts of
bounded bytes by a hash, and a part has one row a pivot (its inverted file) and two rows
with its exact vectors and their ids. It is made once; queries, with orders made once as
well, meet every part and rerank ``read_per_query`` vectors in all, in equal shares of the
parts. That number grows with the root of the table, and neither depends on the number of
parts (but for rounding up) nor has a least value.

Every vector is indexed. Only the pivots are a sample: the ``pivots`` distinct vectors with
the smallest hash. Equal vectors are one entry of the index with the ids that a query can
need: the ``k`` + 1 smallest ones, ``k`` rows of each at most, since one id is a query's own
and the others take at most ``k`` ranks. So copies of one vector, however many, don't push
other vectors out. ``recall`` measures results against brute force.

Vectors that take no part: see ``blocks.valid_vectors``, and zero vectors. Fewer
candidates than k: all that were read are returned. A row that repeats id and vector is one
query, and each such row takes a rank where it is found. No vectors, or no queries: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.llm import blocks
from sparkmine.llm.common import materialised

PIVOTS = 1024
PREFIX = 64
READ = 12.0  # exact vectors read by a query, as a multiple of the root of the table's
VECTORS, IDS = -1, -2  # in place of a pivot's number
FOUND = "query_id long, rank int, vec_id long, score double"


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """For each vector the numbers of its nearest pivots, nearest first, ties to the
    smaller number."""
    far = (pivots**2).sum(axis=1) - 2 * (x @ pivots.T)  # but for the vector's own length
    return np.argsort(far, axis=1, kind="stable")[:, :prefix].astype(np.int32)


def inverted_files(orders: np.ndarray, pivots: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pivot the rows that are posted under it and the places they give it."""
    flat = orders.ravel()
    by_pivot = np.argsort(flat, kind="stable")
    cuts = np.searchsorted(flat[by_pivot], np.arange(pivots + 1))
    rows, places = np.divmod(by_pivot, orders.shape[1])
    return [(rows[a:b], places[a:b]) for a, b in zip(cuts, cuts[1:])]


def footrule(order: np.ndarray, files: dict[int, tuple[np.ndarray, np.ndarray]], rows: int) -> np.ndarray:
    """The footrule distance of a query's order to each posted row. With both orders cut
    at length n it is n (n + 1) less twice the sum, over the shared pivots, of n less the
    later of the two places (places from 0)."""
    n = len(order)
    read = [(place, *files[p]) for place, p in enumerate(order.tolist()) if p in files]
    if not read:
        return np.full(rows, n * (n + 1), dtype=np.int64)
    own = np.repeat([place for place, _, _ in read], [len(posted) for _, posted, _ in read])
    later = np.maximum(own, np.concatenate([places for _, _, places in read]))
    agree = np.bincount(np.concatenate([posted for _, posted, _ in read]), n - later, rows)
    return n * (n + 1) - 2 * agree.astype(np.int64)


def read_per_query(vectors: int, read: float = READ) -> int:
    """How many exact vectors a query reads of an index of so many distinct ones."""
    return min(vectors, int(np.ceil(read * np.sqrt(vectors))))


def choose_pivots(vectors: DataFrame, pivots: int) -> np.ndarray:
    """At most ``pivots`` of the distinct vectors ``v``, on the driver: half a megabyte for
    1,024 of 64 components."""
    chosen = vectors.orderBy(F.xxhash64(F.lit(8), "v"), "v").limit(pivots).select("v").collect()
    return np.array([r["v"] for r in chosen], dtype=np.float64)


def distinct_vectors(fine: DataFrame, k: int) -> DataFrame:
    """(v, ids) of ``fine`` (id, v): each vector once, with its k + 1 smallest ids in order,
    an id as often as rows repeat it and k times at most."""
    rows = fine.groupBy("v", "id").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("n"))
    # The limit by rank is applied before the shuffle too, so a vector with a third of
    # all rows sends k + 1 rows a task.
    least = rows.withColumn("rank", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("rank") <= k + 1)
    ids = F.array_sort(F.collect_list(F.struct("id", "n")))
    return least.groupBy("v").agg(F.flatten(F.transform(ids, lambda r: F.array_repeat(r["id"], r["n"]))).alias("ids"))


def build(vectors: DataFrame, pivots: np.ndarray, prefix: int, parts: int) -> DataFrame:
    """The index of the distinct ``vectors`` (v, ids), written to the shared folder: (part,
    pivot, rows, values). An inverted file's rows are places in the part (int32), its values
    the pivot's places in their orders (uint16). VECTORS: values are the vectors; IDS: rows
    and values are the vectors' places and their ids."""

    def files(frame: pd.DataFrame) -> pd.DataFrame:
        x = np.array(frame["v"].tolist(), dtype=np.float64)
        posted = inverted_files(nearest_pivots(x, pivots, prefix), len(pivots))
        out = [(p, r.astype("<i4").tobytes(), w.astype("<u2").tobytes()) for p, (r, w) in enumerate(posted) if len(r)]
        owner = np.repeat(np.arange(len(x)), [len(i) for i in frame["ids"]])
        ids = np.concatenate([np.asarray(i, dtype="<i8") for i in frame["ids"]])
        out += [(VECTORS, b"", x.astype("<f8").tobytes()), (IDS, owner.astype("<i4").tobytes(), ids.tobytes())]
        made = pd.DataFrame(out, columns=["pivot", "rows", "values"])
        made.insert(0, "part", frame["part"].iat[0])
        return made

    dealt = vectors.withColumn("part", F.pmod(F.xxhash64(F.lit(5), "v"), F.lit(parts)).cast("int"))
    return materialised(dealt.groupBy("part").applyInPandas(files, "part int, pivot int, rows binary, values binary"), "index")


def ask(queries: DataFrame, pivots: np.ndarray, prefix: int) -> DataFrame:
    """(key, query_id, v, order) of the distinct ``queries`` (id, v), written once."""

    @F.pandas_udf("array<int>")
    def order(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for v in batches:
            yield pd.Series(list(nearest_pivots(np.array(v.tolist()), pivots, prefix)) if len(v) else [])

    rows = queries.distinct().select(F.monotonically_increasing_id().alias("key"), F.col("id").alias("query_id"), "v")
    return materialised(rows.withColumn("order", order("v")), "asked")


def search_part(index: pd.DataFrame, asking: pd.DataFrame, k: int, read: int) -> pd.DataFrame:
    """The ``k`` nearest rows (key, query_id, vec_id, score) that each query finds in a part,
    of whose vectors it reads ``read``."""
    files = {int(p): (np.frombuffer(r, "<i4"), v) for p, r, v in zip(index["pivot"], index["rows"], index["values"])}
    owner, ids = files.pop(IDS)
    ids = np.frombuffer(ids, "<i8")
    d = len(asking["v"].iat[0])
    x = np.frombuffer(files.pop(VECTORS)[1], "<f8").reshape(-1, d)
    files = {p: (r, np.frombuffer(v, "<u2").astype(np.int64)) for p, (r, v) in files.items()}
    starts = np.searchsorted(owner, np.arange(len(x) + 1))
    sizes = np.diff(starts)
    out: list[tuple[np.ndarray, ...]] = []
    for key, own, v, order in zip(asking["key"], asking["query_id"], asking["v"], asking["order"]):
        near = np.argsort(footrule(np.asarray(order), files, len(x)), kind="stable")
        alone = sizes[near] == (ids[starts[near]] == own)  # the query's own row and no other
        near = near[~alone][:read]
        far = np.sqrt(((x[near] - np.asarray(v)) ** 2).sum(axis=1))
        # The ids of these vectors lie in runs, one a vector.
        length = sizes[near]
        rows = np.repeat(starts[near] - (np.cumsum(length) - length), length) + np.arange(length.sum())
        found, far = ids[rows], np.repeat(far, length)
        found, far = found[found != own], far[found != own]
        best = np.lexsort((found, far))[:k]
        out.append((np.full(len(best), key), np.full(len(best), own), found[best], far[best]))
    return pd.DataFrame(dict(zip(("key", "query_id", "vec_id", "score"), map(np.concatenate, zip(*out)))))


def nearest(rows: DataFrame, is_query: Column, *, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding",
            pivots: int = PIVOTS, prefix: int = PREFIX, read: float = READ) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found by Euclidean distance,
    for every row where ``is_query`` (an expression on column ``id``)."""
    fine = blocks.valid_vectors(rows, vec_id, vector, nonzero=True)
    vectors = materialised(distinct_vectors(fine, k), "vectors")
    chosen = choose_pivots(vectors, pivots)
    if not len(chosen):
        return fine.sparkSession.createDataFrame([], FOUND)
    width, n = min(prefix, len(chosen)), vectors.count()
    row_bytes = 8 * chosen.shape[1] + 6 * width
    parts = max(blocks.LEAST_BLOCKS, -(-n * row_bytes // blocks.BLOCK_BYTES))
    index = build(vectors, chosen, width, parts)
    asked = ask(fine.filter(is_query), chosen, width)
    asked_parts = max(1, -(-asked.count() * row_bytes // blocks.BLOCK_BYTES))
    share = -(-read_per_query(n, read) // parts)

    def meet(part: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(part) or not len(asking):
            return pd.DataFrame({"key": [], "query_id": [], "vec_id": [], "score": []})
        return search_part(part, asking, k, share)

    left = index.withColumn("asked_part", F.explode(F.sequence(F.lit(0), F.lit(asked_parts - 1))))
    right = asked.withColumn("asked_part", F.pmod(F.xxhash64(F.lit(6), "key"), F.lit(asked_parts)).cast("int"))
    right = right.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    pairs = left.groupBy("part", "asked_part").cogroup(right.groupBy("part", "asked_part")).applyInPandas(
        meet, "key long, query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("key").orderBy("score", "vec_id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def recall(found: DataFrame, exact: DataFrame) -> float:
    """The share of the exact neighbours (query_id, vec_id) that were found."""
    both = exact.join(found, ["query_id", "vec_id"], "left_semi").count()
    return both / max(1, exact.count())
