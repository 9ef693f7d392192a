"""Ordered-sequence operators: positions, item locations and per-category visit
statistics (visits, refreshes, revisits).

Input is the long form ``(seq, pos, item)``. The reference's hand loops over each
sequence become ordered scans per (sequence, item): runs of equal items are islands
``pos - row_number()``, revisits come from the previous position. The scans are the
skew-safe grouped scans of ``scan.py``: when a group (say a user holding a third of
all visits) is too large for one task it is cut into ranges over many tasks; small
groups use plain windows (``skew_safe`` = "auto" / True / False). All aggregates
are partial (map-side) before their shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.operators.scan import grouped_scan, hot_group_rows, largest_group
from sparkmine.session import cut_lineage


def _decide(df: DataFrame, user: str, skew_safe: bool | str) -> bool:
    """One measurement on the coarsest grouping (the user): every group the statistics
    scan (user x category, runs) is a subset of one user's visits."""
    if skew_safe == "auto":
        return largest_group(df, [user]) > hot_group_rows(df.sparkSession)
    return bool(skew_safe)


def with_positions(df: DataFrame, seq: str | list[str], order: list[str], pos: str = "pos",
                   skew_safe: bool | str = "auto", itemsets: bool = False) -> DataFrame:
    """0-based position of each row in its sequence, ties broken by the later order keys.

    ``itemsets=True``: rows equal on the first order key (simultaneous events) share
    one position, i.e. form one itemset step (a dense rank on that key)."""
    if not itemsets:
        out = grouped_scan(df, seq, order, sums={"_rn": F.lit(1).cast("bigint")}, skew_safe=skew_safe)
        return out.withColumn(pos, (F.col("_rn") - 1).cast("bigint")).drop("_rn")
    key = order[0]
    prev = grouped_scan(df, seq, order, lags={"_prev_key": key}, skew_safe=skew_safe)
    step = (F.col("_prev_key").isNull() | (F.col("_prev_key") != F.col(key))).cast("bigint")
    out = grouped_scan(prev.withColumn("_step", step).drop("_prev_key"), seq, order,
                       sums={"_rank": F.col("_step")}, skew_safe=skew_safe)
    return out.withColumn(pos, (F.col("_rank") - 1).cast("bigint")).drop("_rank", "_step")


def item_locations(df: DataFrame, seq: str = "seq_id", item: str = "item", pos: str = "pos") -> DataFrame:
    """First and last position of every item in every sequence: ``(seq, item, first, last)``."""
    return df.groupBy(seq, item).agg(F.min(pos).alias("first"), F.max(pos).alias("last"))


def category_visits(df: DataFrame, user: str = "user_id", cat: str = "category") -> DataFrame:
    """Visits and visiting users per category."""
    return df.groupBy(cat).agg(
        F.count(F.lit(1)).alias("visits"),
        F.count_distinct(user).alias("unique_visits"),
    )


def _runs(df: DataFrame, user: str, cat: str, pos: str, skew_safe: bool | str = "auto") -> DataFrame:
    """Maximal runs of one category inside a user's sequence: ``(user, cat, start, L)``."""
    numbered = grouped_scan(df.select(user, cat, pos), [user, cat], [pos],
                            sums={"_rn": F.lit(1).cast("bigint")}, skew_safe=skew_safe)
    island = numbered.select(user, cat, pos, (F.col(pos) - F.col("_rn")).alias("_island"))
    return island.groupBy(user, cat, "_island").agg(F.min(pos).alias("start"), F.count(F.lit(1)).alias("L"))


def refresh_emissions(df: DataFrame, user: str = "user_id", cat: str = "category", pos: str = "pos",
                      mode: str = "runs", skew_safe: bool | str = "auto") -> DataFrame:
    """One row per counted refresh streak: ``(user, cat, emitted)``.

    ``runs``: a run of L >= 2 equal visits is L-1 refreshes (the documented intent).
    ``carry``: what the reference's scan computes: its counter resets only after a run of
    two or more, so lone visits carry over gaps. Closed form: start a new group after
    each run with L >= 2; c = (earlier single runs in the group) mod 2; a run with
    L >= 2 emits L-1+c, a single run emits 1 when c = 1.
    """
    if mode not in ("runs", "carry"):
        raise ValueError("mode must be 'runs' or 'carry'")
    skew_safe = _decide(df, user, skew_safe)
    runs = _runs(df, user, cat, pos, skew_safe)
    if mode == "carry" and skew_safe:
        runs = cut_lineage(runs)  # range-partitioned twice; plain windows shuffle it once
    if mode == "runs":
        return runs.filter(F.col("L") >= 2).select(user, cat, (F.col("L") - 1).alias("emitted"))
    long_run = (F.col("L") >= 2).cast("bigint")
    single = (F.col("L") == 1).cast("bigint")
    # group = long runs strictly before this run; c = single runs before it in its group, mod 2
    grouped = grouped_scan(runs.withColumn("_long", long_run), [user, cat], ["start"],
                           sums={"_g_incl": F.col("_long")}, skew_safe=skew_safe)
    grouped = grouped.withColumn("_grp", F.col("_g_incl") - F.col("_long")).drop("_g_incl", "_long")
    carried = grouped_scan(grouped.withColumn("_single", single), [user, cat, "_grp"], ["start"],
                           sums={"_s_incl": F.col("_single")}, skew_safe=skew_safe)
    carried = carried.withColumn("_c", (F.col("_s_incl") - F.col("_single")) % 2)
    emitted = (F.when(F.col("L") >= 2, F.col("L") - 1 + F.col("_c"))
               .when(F.col("_c") == 1, F.lit(1)))
    return carried.select(user, cat, emitted.cast("bigint").alias("emitted")).filter(F.col("emitted").isNotNull())


def revisit_distances(df: DataFrame, user: str = "user_id", cat: str = "category", pos: str = "pos",
                      skew_safe: bool | str = "auto") -> DataFrame:
    """Each return to a category after other pages: ``(user, cat, distance)`` with
    distance = pages visited in between (adjacent repeats are refreshes, not revisits)."""
    prev = grouped_scan(df.select(user, cat, pos), [user, cat], [pos], lags={"_prev": pos},
                        skew_safe=_decide(df, user, skew_safe))
    gap = F.col(pos) - F.col("_prev")
    return (prev.select(user, cat, gap.alias("_gap"))
            .filter(F.col("_gap") > 1)
            .select(user, cat, (F.col("_gap") - 1).alias("distance")))


def _summary(events: DataFrame, user: str, cat: str, value: str, prefix: str, singular: str,
             total: Column) -> DataFrame:
    return events.groupBy(cat).agg(
        total.cast("bigint").alias(prefix),
        F.count_distinct(user).alias(f"unique_{prefix}"),
        F.max(value).cast("bigint").alias(f"longest_{singular}"),
        F.min(value).cast("bigint").alias(f"shortest_{singular}"),
    )


def refresh_stats(df: DataFrame, user: str = "user_id", cat: str = "category", pos: str = "pos",
                  mode: str = "runs", skew_safe: bool | str = "auto") -> DataFrame:
    """Per category: refreshes, users with one, longest and shortest streak."""
    return _summary(refresh_emissions(df, user, cat, pos, mode, skew_safe), user, cat, "emitted", "refreshes",
                    "refresh",
                    F.sum("emitted"))


def revisit_stats(df: DataFrame, user: str = "user_id", cat: str = "category", pos: str = "pos",
                  skew_safe: bool | str = "auto") -> DataFrame:
    """Per category: revisits, users with one, longest and shortest distance."""
    return _summary(revisit_distances(df, user, cat, pos, skew_safe), user, cat, "distance", "revisits", "revisit",
                    F.count(F.lit(1)))


STAT_COLUMNS = ("visits", "unique_visits", "refreshes", "unique_refreshes", "revisits", "unique_revisits",
                "longest_refresh", "shortest_refresh", "longest_revisit", "shortest_revisit")


def category_stats(df: DataFrame, user: str = "user_id", cat: str = "category", pos: str = "pos",
                   mode: str = "carry", categories: DataFrame | None = None, skew_safe: bool | str = "auto") -> DataFrame:
    """The full ten-column table; every category of the dimension is kept, with zeros.

    ``categories`` is the category dimension (one column named like ``cat``); by
    default the categories seen in the data. The three per-category tables are tiny
    (one row per category), so the joins between them are cheap.
    """
    df = df.select(user, cat, pos)
    skew_safe = _decide(df, user, skew_safe)
    if skew_safe:
        df = cut_lineage(df)  # the ranges that positions came from are not sampled again
    dim = categories if categories is not None else df.select(cat).distinct()
    out = (dim.join(category_visits(df, user, cat), cat, "left")
           .join(refresh_stats(df, user, cat, pos, mode, skew_safe), cat, "left")
           .join(revisit_stats(df, user, cat, pos, skew_safe), cat, "left"))
    cols: list[Column] = [F.col(cat)] + [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in STAT_COLUMNS]
    return out.select(*cols)
