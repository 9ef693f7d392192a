"""Centroid clustering of integer vectors with Ns-bounds: every vector is assigned to the
centroid that an exhaustive search would find, mostly without looking at it.

For each vector and centroid the state holds the distance as it was when last evaluated,
and the round of that. The driver keeps all centroids of all rounds (rounds x k x
components, a bound by parameters). In a later round the distance is at least the held one
less the norm of the centroid's total displacement since that very round (not the sum of its
drifts round by round, which is never smaller). A vector whose own centroid, by its loosened
upper bound, is nearer than the lower bounds of all others keeps it unseen; where that
fails, its own centroid is evaluated, and then exactly those whose bound lies below that.

All decisions compare integer squared distances; bounds are rounded to the safe side, so
they can cost evaluations but not change results. One pass over the vectors a round, with
no shuffle of rows: k rows of sums from each task cross to the update. The state is a written
table, so a lost executor repeats no earlier round; the one before it is deleted.

Defined cases: rows with a null vector, a null or non-finite component, another number of
components, or a squared length of 2**60 or more (distances wouldn't fit a long) take no
part; rows without an id do, but start as centroids only after all others; repeated rows are
rows of their own, and of equal hashes the smaller vector starts first; with fewer rows than
k there are as many centroids; an empty table gives no rows; columns other than the id aren't
returned, so names can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.common import materialised
from sparkmine.session import delete_path, scratch_path

ROWS_AT_ONCE = 2_048
SLACK = 1e-6  # relative; distances are held in single precision


class Clusters(NamedTuple):
    assigned: DataFrame  # (id, cluster int, distance long)
    centroids: np.ndarray  # k x components, long
    evaluated: list[int]  # distances evaluated in each pass


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component x, taken as a double."""
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale))))


def usable(vector: Column, scale: int, bits: int) -> Column:
    """Neither null nor holding a null or non-finite component, and of a squared length,
    scaled, below ``2 ** bits``."""
    v = vector.cast("array<double>")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    square = F.aggregate(v, F.lit(0.0), lambda s, x: s + (F.abs(x * float(scale)) + 1) * (F.abs(x * float(scale)) + 1))
    return v.isNotNull() & F.coalesce(whole, F.lit(False)) & F.coalesce(square < float(2**bits), F.lit(False))


def displacements(history: list[np.ndarray]) -> np.ndarray:
    """rounds x k: how far each centroid is now from where it was in each round, rounded up."""
    far = [np.sqrt(np.square((history[-1] - old).astype(np.float64)).sum(axis=1)) for old in history]
    return np.array(far) * (1 + 1e-9)


class State(NamedTuple):
    """Of n vectors: cluster, upper bound's distance and round, lower bounds and rounds."""

    cluster: np.ndarray
    lower: np.ndarray  # n x k; of the own centroid it is the upper bound as well
    since: np.ndarray  # n x k


def assign(z: np.ndarray, state: State | None, history: list[np.ndarray], drift: np.ndarray) -> tuple[State, int]:
    """The state after a pass with the last centroids of ``history``, and how many
    distances were evaluated. ``state`` None: all are."""
    now, centroids = len(history) - 1, history[-1]
    n, k = len(z), len(centroids)
    if state is None:
        square = np.stack([np.square(z - c).sum(axis=1) for c in centroids], axis=1)
        return State(square.argmin(axis=1), np.sqrt(square), np.full((n, k), now, dtype=np.int16)), n * k
    cluster, lower, since = state.cluster.copy(), state.lower.astype(np.float64), state.since.copy()
    rows = np.arange(n)
    moved = drift[since, np.arange(k)]
    bound = lower - moved
    bound -= SLACK * (lower + moved + 1)  # rounding goes to the safe side
    bound[rows, cluster] = np.inf
    upper = (lower[rows, cluster] + moved[rows, cluster]) * (1 + SLACK) + SLACK
    fail = np.flatnonzero(bound.min(axis=1) <= upper)
    if not len(fail):
        return State(cluster, lower, since), 0
    own = cluster[fail]
    best = np.square(z[fail] - centroids[own]).sum(axis=1)  # exact
    lower[fail, own], since[fail, own] = np.sqrt(best), now
    upper = np.sqrt(best) * (1 + SLACK) + SLACK
    evaluated = len(fail)
    for j in range(k):
        near = np.flatnonzero(bound[fail, j] <= upper)
        if not len(near):
            continue
        at = fail[near]
        square = np.square(z[at] - centroids[j]).sum(axis=1)
        lower[at, j], since[at, j] = np.sqrt(square), now
        evaluated += len(at)
        better = (square < best[near]) | ((square == best[near]) & (j < cluster[at]))
        cluster[at[better]], best[near[better]] = j, square[better]
    return State(cluster, lower, since), evaluated


_STATE = "id long, z array<int>, cluster int, lower array<float>, since array<short>, evaluated long"


def _pass(history: list[np.ndarray]):
    drift = displacements(history)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.iloc[at:at + ROWS_AT_ONCE]
                z = np.array(part["z"].tolist(), dtype=np.int64)
                before = None
                if "cluster" in part:
                    before = State(part["cluster"].to_numpy(dtype=np.int64), np.array(part["lower"].tolist()),
                                   np.array(part["since"].tolist(), dtype=np.int16))
                after, evaluated = assign(z, before, history, drift)
                share = np.zeros(len(part), dtype=np.int64)
                share[0] = evaluated
                yield pd.DataFrame({"id": part["id"].astype("Int64"), "z": part["z"], "cluster": after.cluster, "lower": list(after.lower.astype(np.float32)),
                                    "since": list(after.since), "evaluated": share})

    return run


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row a cluster from each task: its rows and their components' sums."""
    total: dict[int, list] = {}
    evaluated = 0
    for batch in batches:
        z, cluster = np.array(batch["z"].tolist(), dtype=np.int64), batch["cluster"].to_numpy()
        evaluated += int(batch["evaluated"].sum())
        for c in np.unique(cluster):
            seen = total.setdefault(int(c), [0, 0])
            seen[0] += int((cluster == c).sum())
            seen[1] += z[cluster == c].sum(axis=0)
    for i, (c, (n, s)) in enumerate(total.items()):
        yield pd.DataFrame({"cluster": [c], "n": [n], "sums": [s], "evaluated": [evaluated if i == 0 else 0]})


def _updated(state: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, int]:
    """Exact floored means of the members (k x components reach the driver), and the
    number of distances that the pass evaluated."""
    parts = state.select("z", "cluster", "evaluated").mapInPandas(_sums, "cluster int, n long, sums array<long>, evaluated long")
    long = parts.select("cluster", "n", "evaluated", F.posexplode("sums").alias("dim", "x"))
    exact = long.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum("evaluated").alias("e"))
    out, evaluated = centroids.copy(), 0
    for r in exact.collect():
        out[r["cluster"], r["dim"]] = int(r["x"]) // int(r["n"])
        evaluated += int(r["e"]) if r["dim"] == 0 else 0
    return out, evaluated


def start_hash(vec_id: Column, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(salt), vec_id.cast("string")), 256)


def cluster(rows: DataFrame, *, k: int = 40, rounds: int = 5, components: int = 64, scale: int = 256, salt: str = "2:",
            vec_id: str = "vec_id", vector: str = "embedding") -> Clusters:
    """``rounds`` rounds of assignment and floored means from ``k`` rows chosen by hash, then
    a last assignment."""
    v = F.col(vector)
    kept = rows.filter((F.size(v) == components) & usable(v, scale, 60))
    kept = kept.select(F.col(vec_id).cast("long").alias("id"), quantised(v, scale).cast("array<int>").alias("z"))
    first = kept.orderBy(start_hash(F.col("id"), salt).asc_nulls_last(), "z").limit(k).select("z").collect()
    if not first:
        empty = kept.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return Clusters(empty, np.zeros((0, components), dtype=np.int64), [])
    history = [np.array([r["z"] for r in first], dtype=np.int64)]
    state, path, evaluated = kept, None, []
    for _ in range(rounds):
        state, path, before = *_written(state.mapInPandas(_pass(history), _STATE)), path
        if before:
            delete_path(rows.sparkSession, before)
        centroids, n = _updated(state, history[-1])
        evaluated.append(n)
        history.append(centroids)
    final = state.mapInPandas(_pass(history), _STATE)
    last = history[-1]

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            z = np.array(batch["z"].tolist(), dtype=np.int64)
            own = batch["cluster"].to_numpy(dtype=np.int64)
            yield pd.DataFrame({"id": batch["id"].astype("Int64"), "cluster": own, "distance": np.square(z - last[own]).sum(axis=1),
                                "evaluated": batch["evaluated"]})

    # Both steps in one task: the rows go from one Python function to the other.
    out = materialised(final.mapInPandas(measured, "id long, cluster int, distance long, evaluated long"), "assigned")
    if path:
        delete_path(rows.sparkSession, path)
    evaluated.append(int(out.agg(F.sum("evaluated")).first()[0]))
    return Clusters(out.select("id", "cluster", "distance"), last, evaluated)


def _written(state: DataFrame) -> tuple[DataFrame, str]:
    path = scratch_path(state.sparkSession, "bounds")
    state.write.parquet(path)
    return state.sparkSession.read.schema(state.schema).parquet(path), path


def with_inertia(found: Clusters) -> DataFrame:
    """``assigned`` with cluster_inertia, inertia (null beyond a long) and each centroid's
    sha256, all broadcast: one row a cluster."""
    spark = found.assigned.sparkSession
    whole = found.assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    own = {r["cluster"]: int(r["s"]) for r in whole}
    all_of = sum(own.values())

    def fits(x: int) -> int | None:
        return x if x < 1 << 63 else None

    rows = [(c, fits(s), fits(all_of), hashlib.sha256(",".join(map(str, found.centroids[c].tolist())).encode()).hexdigest()) for c, s in own.items()]
    table = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.assigned.join(F.broadcast(table), "cluster")
