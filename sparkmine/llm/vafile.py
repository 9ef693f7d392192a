"""Exact top-k by inner product with vector-approximation files.

Each block of vectors is quantised: every dimension is cut at its quantiles into cells,
and a vector is kept as one small code per dimension. A query first scans the codes alone:
the corners of a vector's cell give the largest inner product that it can have. Exact
vectors are then read in the order of these bounds, best first, until the k-th exact score
is above the next bound, which makes the result certain.

Components are whole numbers (floor(scale * x)), so products are summed without rounding
as long as they stay below 2**53; where they may not, exact scores are summed as Python
integers and bounds get room for rounding, and a score that no long can hold is set to
the nearest long. Vectors that take no part: see ``blocks.valid_vectors``. Fewer
candidates than k: all are returned. No vectors, or no queries: no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.llm import blocks
from sparkmine.llm.blocks import stacked

CELLS = 32
READ = 32  # exact vectors read at once
QUERIES_AT_ONCE = 128


def approximate(x: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """(codes, edges): ``edges[j]`` are the cells + 1 bounds of dimension j, the outer ones
    its least and greatest value, and ``codes[i, j]`` the cell in which x[i, j] lies."""
    edges = np.quantile(x, np.linspace(0, 1, cells + 1), axis=0, method="lower").T
    codes = np.empty(x.shape, dtype=np.uint8)
    for j in range(x.shape[1]):
        codes[:, j] = np.clip(np.searchsorted(edges[j], x[:, j], side="right") - 1, 0, cells - 1)
    return codes, edges


def upper_bounds(q: np.ndarray, codes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """For each query (row) and code the largest inner product of the query with a point
    of the code's cell: the upper corner where the query is positive, else the lower."""
    dims = np.arange(codes.shape[1])
    low, high = edges[dims, codes], edges[dims, codes + 1]
    return np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T


def _exact(x: np.ndarray, q: np.ndarray, whole: bool) -> np.ndarray:
    if whole:
        return x @ q
    return np.array([sum(int(a) * int(b) for a, b in zip(row, q)) for row in x], dtype=object)


def search(x: np.ndarray, ids: np.ndarray, q: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query (ids, scores) of its ``k`` best rows, ties to the smaller id."""
    codes, edges = approximate(x)
    whole = float(np.abs(x).max()) * float(np.abs(q).max()) * x.shape[1] < 2.0**53
    limits = np.iinfo(np.int64)
    out = []
    for start in range(0, len(q), QUERIES_AT_ONCE):
        part = q[start:start + QUERIES_AT_ONCE]
        bounds = upper_bounds(part, codes, edges)
        if not whole:
            bounds = bounds + np.maximum(np.abs(part) @ np.abs(edges).max(axis=1), 1.0)[:, None] * 1e-9
        for i, bound in enumerate(bounds):
            order = np.argsort(-bound, kind="stable")
            order = order[ids[order] != own[start + i]]
            best: list[tuple] = []  # (-score, id), ascending
            for at in range(0, len(order), READ):
                if len(best) == k and bound[order[at]] < -best[-1][0]:
                    break
                rows = order[at:at + READ]
                best = sorted([*best, *zip((-_exact(x[rows], part[i], whole)).tolist(), ids[rows].tolist())])[:k]
            out.append((np.array([b[1] for b in best], dtype=np.int64),
                        np.array([min(max(int(-b[0]), limits.min), limits.max) for b in best], dtype=np.int64)))
    return out


def top_k(rows: DataFrame, is_query: Column, *, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding",
          scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows with the highest inner product of
    floor(scale * x), for every row where ``is_query`` (an expression on column ``id``)."""
    fine = blocks.valid_vectors(rows, vec_id, vector)
    fine = fine.withColumn("v", F.transform("v", lambda x: F.rint(F.floor(x * scale).cast("double"))))

    def meet(block: pd.DataFrame, asking: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
        frame, x = stacked(block)
        queries, q = stacked(asking, distinct=True)
        return search(x, frame["id"].to_numpy(), q, queries["id"].to_numpy(), k)

    return blocks.nearest(fine, fine.filter(is_query), meet, k, score="long", descending=True)
