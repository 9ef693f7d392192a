"""Searching a stated set of query vectors against all vectors, block by block.

All vectors are dealt to blocks by a hash of their id, the queries to query blocks; every
pair of a block and a query block meets once in one task, which returns its nearest rows
only. A block's bytes are bounded, so a task's memory doesn't grow with the table, and the
number of blocks does."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BYTES = 16 << 20
LEAST_BLOCKS = 48  # so that a small table is spread over tasks too

#: (ids, vectors, extra columns) of a block and of its queries -> for each query the
#: positions and scores of its best rows, best first.
Search = Callable[[pd.DataFrame, pd.DataFrame], list[tuple[np.ndarray, np.ndarray]]]


def valid_vectors(rows: DataFrame, vec_id: str, vector: str, nonzero: bool = False) -> DataFrame:
    """(id, v array<double>) of the rows that take part: not those with a null id, a null
    vector, a null or non-finite component, another length than the commonest one (of
    equally common ones the largest) or, if ``nonzero``, only zeros."""
    v = F.col("v")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fine = rows.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    fine = fine.filter(F.col("id").isNotNull() & v.isNotNull()).filter(F.coalesce(whole, F.lit(False)) & (F.size("v") > 0))
    if nonzero:
        fine = fine.filter(F.exists(v, lambda x: x != 0))
    length = fine.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return fine.filter(F.size("v") == (length["n"] if length else 0))


def stacked(frame: pd.DataFrame, distinct: bool = False) -> tuple[pd.DataFrame, np.ndarray]:
    """A block's rows in the order of their ids and their matrix; with ``distinct`` (for
    queries) repeated rows once."""
    v = np.array(frame["v"].tolist(), dtype=np.float64)
    order = sorted(range(len(v)), key=lambda i: (frame["id"].iat[i], v[i].tobytes()))
    once = [i for k, i in enumerate(order)
            if not distinct or not k or frame["id"].iat[i] != frame["id"].iat[order[k - 1]] or (v[i] != v[order[k - 1]]).any()]
    return frame.iloc[once].reset_index(drop=True), v[once]


def nearest(vectors: DataFrame, queries: DataFrame, search: Search, k: int, *, score: str, descending: bool) -> DataFrame:
    """(query_id, rank from 1, vec_id, score) of each query's best ``k`` rows.

    ``vectors`` and ``queries``: id, v and any further columns that ``search`` needs. A
    query's own id is never found. A row that repeats id and vector is one query, but each
    such row takes a rank of its own where it is found. Ties go to the smaller id. ``score``: its Spark type."""
    size = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    asked = queries.count()
    row_bytes = 8 * (size["d"] or 1)
    blocks = max(LEAST_BLOCKS, -(-size["n"] * row_bytes // BLOCK_BYTES))
    query_blocks = max(1, -(-asked * row_bytes // BLOCK_BYTES))

    def dealt(rows: DataFrame, own: str, parts: int, other: str, others: int) -> DataFrame:
        rows = rows.withColumn(own, F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(parts)).cast("int"))
        return rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    left = dealt(vectors, "block", blocks, "query_block", query_blocks)
    right = dealt(queries, "query_block", query_blocks, "block", blocks)

    def meet(block: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        found = search(block, asking) if len(block) and len(asking) else []
        out = [pd.DataFrame({"key": key, "query_id": query, "vec_id": ids, "score": scores})
               for (key, query), (ids, scores) in zip(_query_keys(asking), found)]
        return pd.concat(out) if out else pd.DataFrame({"key": [], "query_id": [], "vec_id": [], "score": []})

    pairs = left.groupBy("block", "query_block").cogroup(right.groupBy("block", "query_block")).applyInPandas(
        meet, f"key long, query_id long, vec_id long, score {score}")
    best = [F.desc("score") if descending else F.asc("score"), F.asc("vec_id")]
    rank = F.row_number().over(Window.partitionBy("query_id", "key").orderBy(*best))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _query_keys(asking: pd.DataFrame) -> list[tuple[int, int]]:
    """(hash of the vector, id): rows with one id and different vectors are two queries."""
    import xxhash

    frame, v = stacked(asking, distinct=True)
    return [(xxhash.xxh64_intdigest(v[i].tobytes()) - (1 << 63), int(frame["id"].iat[i])) for i in range(len(v))]


