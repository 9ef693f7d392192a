"""Registered sequence queries: positions, item locations, visit statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmine.operators import sequences as S
from sparkmine.plans import views as V
from sparkmine.plans.catalog import register
from sparkmine.plans.oracle_views import VIEW_SQL
from sparkmine.plans.oracle_views import with_views as W
from sparkmine.sources.lines import CATEGORIES

_RUNS = """isl as (select user_id, category, pos,
  pos - row_number() over (partition by user_id, category order by pos) as island from visits),
runs as (select user_id, category, island, min(pos) as start, count(*) as L from isl group by user_id, category, island)"""

_CARRY = _RUNS + """,
g as (select *, coalesce(sum(case when L >= 2 then 1 else 0 end) over (partition by user_id, category order by start
  rows between unbounded preceding and 1 preceding), 0) as grp from runs),
c as (select *, coalesce(sum(case when L = 1 then 1 else 0 end) over (partition by user_id, category, grp order by start
  rows between unbounded preceding and 1 preceding), 0) % 2 as c from g),
e as (select user_id, category, case when L >= 2 then L - 1 + c when c = 1 then 1 end as emitted from c)"""

_RUNS_E = _RUNS + """,
e as (select user_id, category, L - 1 as emitted from runs where L >= 2)"""

_REFRESH = """select category, cast(sum(emitted) as bigint) as refreshes, count(distinct user_id) as unique_refreshes,
  cast(max(emitted) as bigint) as longest_refresh, cast(min(emitted) as bigint) as shortest_refresh
from e where emitted is not null group by category"""

_REVISIT_E = """r as (select user_id, category, pos - lag(pos) over (partition by user_id, category order by pos) as gap
  from visits),
rv as (select user_id, category, gap - 1 as distance from r where gap > 1)"""

_REVISIT = """select category, cast(sum(distance) as bigint) as revisits, count(distinct user_id) as unique_revisits,
  cast(max(distance) as bigint) as longest_revisit, cast(min(distance) as bigint) as shortest_revisit
from rv group by category"""


def _with(body: str, final: str) -> str:
    return W(final, "visits").replace("\n" + final, ",\n" + body + "\n" + final, 1)


@register("sequence_positions", W("select * from sequences", "sequences"))
def sequence_positions(spark, d):
    return V.sequences(spark, d)


@register("item_locations", W("""select seq_id, item, min(pos) as first, max(pos) as last from sequences
group by seq_id, item""", "sequences"))
def item_locations(spark, d):
    return S.item_locations(V.sequences(spark, d))


@register("category_visits", W("""select category, count(*) as visits, count(distinct user_id) as unique_visits
from visits group by category""", "visits"))
def category_visits(spark, d):
    return S.category_visits(V.visit_events(spark, d))


@register("refresh_stats", _with(_CARRY, _REFRESH))
def refresh_stats(spark, d):
    return S.refresh_stats(V.visits(spark, d), mode="carry")


@register("refresh_stats_runs", _with(_RUNS_E, _REFRESH))
def refresh_stats_runs(spark, d):
    return S.refresh_stats(V.visits(spark, d), mode="runs")


@register("revisit_stats", _with(_REVISIT_E, _REVISIT.replace("cast(sum(distance) as bigint) as revisits",
                                                                "count(*) as revisits")))
def revisit_stats(spark, d):
    return S.revisit_stats(V.visits(spark, d))


_STATS = """select dim.category,
  coalesce(vi.visits, 0) as visits, coalesce(vi.unique_visits, 0) as unique_visits,
  coalesce(rf.refreshes, 0) as refreshes, coalesce(rf.unique_refreshes, 0) as unique_refreshes,
  coalesce(rv2.revisits, 0) as revisits, coalesce(rv2.unique_revisits, 0) as unique_revisits,
  coalesce(rf.longest_refresh, 0) as longest_refresh, coalesce(rf.shortest_refresh, 0) as shortest_refresh,
  coalesce(rv2.longest_revisit, 0) as longest_revisit, coalesce(rv2.shortest_revisit, 0) as shortest_revisit
from (select distinct category from visits) dim
left join (select category, count(*) as visits, count(distinct user_id) as unique_visits from visits group by category) vi
  on dim.category = vi.category
left join (""" + _REFRESH + """) rf on dim.category = rf.category
left join (""" + _REVISIT.replace("cast(sum(distance) as bigint) as revisits", "count(*) as revisits") + """) rv2
  on dim.category = rv2.category"""


@register("category_stats", _with(_CARRY + ",\n" + _REVISIT_E, _STATS))
def category_stats(spark, d):
    return S.category_stats(V.visits(spark, d), mode="carry")


_DIMENSION = f"(select unnest({list(CATEGORIES)}) as category) dim"
_NAMED = _with(_CARRY + ",\n" + _REVISIT_E, _STATS.replace("(select distinct category from visits) dim", _DIMENSION))


@register("category_stats_17", _NAMED.replace("with visits as (" + VIEW_SQL["visits"], "with visits as (" + VIEW_SQL["named_visits"]))
def category_stats_17(spark, d):
    """Over the fixed 17 categories; those that never occur have a row of zeros."""
    dim = spark.range(1).select(F.explode(F.array(*[F.lit(c) for c in CATEGORIES])).alias("category"))
    return S.category_stats(V.named_visits(spark, d), mode="carry", categories=dim)
