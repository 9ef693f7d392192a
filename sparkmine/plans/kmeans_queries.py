"""Registered k-means queries over the embedding vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmine.operators import kmeans as K
from sparkmine.plans import views as V
from sparkmine.plans.catalog import register
from sparkmine.plans.oracle_views import VIEW_SQL
from sparkmine.plans.oracle_views import with_views as W

K_CLUSTERS = 4
ROUNDS = 3
MAX_ROUNDS = 100

_C0 = ("c0", f"""select row_number() over (order by vec_id) - 1 as cid, v as cv
  from (select * from vectors order by vec_id limit {K_CLUSTERS})""")

_DIST = "list_sum(list_transform(range(1, len(p.v) + 1), lambda j: (p.v[j] - c.cv[j]) * (p.v[j] - c.cv[j])))"


def _round_ctes(i: int) -> list[tuple[str, str]]:
    """Round i: assign to c{i}, average into m{i}, reassemble c{i+1}."""
    return [
        (f"d{i}", f"select p.vec_id, p.v, c.cid, {_DIST} as dist from vectors p cross join c{i} c"),
        (f"a{i}", f"""select vec_id, v, cid from (select *, row_number() over (partition by vec_id order by dist, cid)
  as rk from d{i}) where rk = 1"""),
        (f"m{i}", f"""select cid, dim, avg(x) as x from (select cid, generate_subscripts(v, 1) - 1 as dim, unnest(v) as x
  from a{i}) group by cid, dim"""),
        (f"c{i + 1}", f"select cid, list(x order by dim) as cv from m{i} group by cid"),
    ]


def _rounds(n: int) -> list[tuple[str, str]]:
    out = [_C0]
    for i in range(n):
        out += _round_ctes(i)
    return out


# Rounds of assigning and averaging until no centroid moves, then the last assignment.
_FIT = f"""with recursive vectors as ({VIEW_SQL["vectors"]}), c0 as ({_C0[1]}),
r as (
  select 0 as round, cid, cv, true as moved from c0
  union all
  select n.round, n.cid, n.cv, bool_or(n.shift) over () as moved
  from (
    select c.round + 1 as round, m.cid, m.cv, list_distance(m.cv, c.cv) > 1e-9 as shift
    from (select cid, list(x order by dim) as cv from (
        select cid, dim, avg(x) as x from (
          select cid, generate_subscripts(v, 1) as dim, unnest(v) as x from (
            select p.vec_id, p.v, c.cid, row_number() over (partition by p.vec_id order by {_DIST}, c.cid) as rk
            from vectors p cross join r c where c.moved) where rk = 1) group by cid, dim) group by cid) m
    join r c on c.cid = m.cid where c.moved) n
  where n.round <= {MAX_ROUNDS}),
l as (select * from r where round = (select max(round) from r))
select vec_id, cid, round(dist, 6) as dist, (select max(round) from r)::int as rounds, not (select bool_or(moved) from l) as converged
from (select p.vec_id, c.cid, {_DIST} as dist,
    row_number() over (partition by p.vec_id order by {_DIST}, c.cid) as rk from vectors p cross join l c) where rk = 1"""


def _points(spark, d):
    return V.vectors(spark, d)


@register("kmeans_assign", W("select vec_id, cid from a0", "vectors", extra=_rounds(1)))
def kmeans_assign(spark, d):
    pts = _points(spark, d)
    init = K.initial_centroids(pts, K_CLUSTERS)
    return K.assign(pts, init).select("vec_id", "cid")


@register("kmeans_step", W("select cid, cast(dim as int) as dim, round(x, 6) as x from m0", "vectors",
                           extra=_rounds(1)))
def kmeans_step(spark, d):
    pts = _points(spark, d)
    init = K.initial_centroids(pts, K_CLUSTERS)
    return K.update(K.assign(pts, init)).select("cid", "dim", F.round("x", 6).alias("x"))


@register("kmeans_3_rounds", W(f"select cid, cast(dim as int) as dim, round(x, 6) as x from m{ROUNDS - 1}", "vectors",
                               extra=_rounds(ROUNDS)))
def kmeans_3_rounds(spark, d):
    pts = _points(spark, d)
    init = K.initial_centroids(pts, K_CLUSTERS)
    cents = K.fit(pts, init=init, max_iter=ROUNDS - 1).centroids
    return K.step(pts, cents).select("cid", "dim", F.round("x", 6).alias("x"))


@register("kmeans_fit", _FIT)
def kmeans_fit(spark, d):
    """Fit to convergence; the final assignment of every vector, how many rounds it took
    and whether it converged."""
    pts = _points(spark, d)
    cents, rounds, converged = K.fit(pts, k=K_CLUSTERS, max_iter=MAX_ROUNDS)
    return K.assign(pts, cents).select(
        "vec_id", "cid", F.round("dist", 6).alias("dist"), F.lit(rounds).alias("rounds"), F.lit(converged).alias("converged"))
