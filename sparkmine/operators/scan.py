"""Ordered scans inside groups that stay balanced when one group holds a large share
of all rows: row numbers, running sums and the previous value, per group, in order.

A plain ``Window.partitionBy(group)`` sends a whole group to one task. Here rows are
range-partitioned on ``(group, order)`` instead, so a hot group is cut into many
contiguous ranges on different tasks. Each task scans its own pieces with a window
partitioned by ``(range partition, group)`` (bounded by one range partition), and
only the groups that continue from an earlier range partition need a carry-in.
A range partition starts with at most one such continuing group, so the carry-in
table has fewer rows than there are range partitions: it is broadcast with that
proven bound. The ranged rows are checkpointed once so both passes see the same
partitioning, and a lost executor never re-samples the range bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.session import cut_lineage

_PID = "_scan_pid"

# Groups up to this many rows are scanned with a plain window (one task per group);
# any larger group switches the scan to range-split pieces. Session conf
# ``sparkmine.scan.hotGroupRows`` overrides it.
HOT_GROUP_ROWS = 2_000_000


def hot_group_rows(spark) -> int:
    return int(spark.conf.get("sparkmine.scan.hotGroupRows", str(HOT_GROUP_ROWS)))


def largest_group(df: DataFrame, group: list[str]) -> int:
    """Rows in the largest group (a partial aggregate, then one max)."""
    row = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()
    return int(row[0] or 0)


def _cols(c: str | Sequence[str]) -> list[str]:
    return [c] if isinstance(c, str) else list(c)


def _ranged(df: DataFrame, group: list[str], order: list[str], partitions: int | None) -> DataFrame:
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *group, *order).withColumn(_PID, F.spark_partition_id())
    return cut_lineage(ranged)


def grouped_scan(df: DataFrame, group: str | Sequence[str], order: str | Sequence[str],
                 sums: dict[str, Column] | None = None, lags: dict[str, str] | None = None,
                 partitions: int | None = None, skew_safe: bool | str = "auto") -> DataFrame:
    """Adds, per group in ``order`` (a total order inside each group):

    * ``sums``: ``{name: value}`` inclusive running sums (``F.lit(1)`` gives the row number);
    * ``lags``: ``{name: column}`` the column's value on the previous row of the group.

    ``skew_safe``: True = range-split pieces; False = plain window; ``"auto"`` = measure
    the largest group first and split only when it exceeds ``hot_group_rows``.
    """
    g, o = _cols(group), _cols(order)
    sums, lags = dict(sums or {}), dict(lags or {})
    if skew_safe == "auto":
        skew_safe = largest_group(df, g) > hot_group_rows(df.sparkSession)
    if not skew_safe:
        w = Window.partitionBy(*g).orderBy(*o)
        out = df
        for name, v in sums.items():
            out = out.withColumn(name, F.sum(v).over(w.rowsBetween(Window.unboundedPreceding, 0)))
        for name, c in lags.items():
            out = out.withColumn(name, F.lag(c).over(w))
        return out

    vals = {f"_v_{k}": v for k, v in sums.items()}
    ranged = _ranged(df.select("*", *[v.alias(k) for k, v in vals.items()]), g, o, partitions)
    local_w = Window.partitionBy(_PID, *g).orderBy(*o)
    running = local_w.rowsBetween(Window.unboundedPreceding, 0)
    local = ranged
    for name in sums:
        local = local.withColumn(f"_l_{name}", F.sum(f"_v_{name}").over(running))
    for name, c in lags.items():
        local = local.withColumn(f"_l_{name}", F.lag(c).over(local_w))
    if lags:
        local = local.withColumn("_l__first", F.row_number().over(local_w) == 1)

    # Per (range partition, group): totals and the last row's values; then what the
    # earlier range partitions of the same group carry in (at most one per partition).
    lag_fields = {name: f"_x{i}" for i, name in enumerate(lags)}
    last = (F.max_by(F.struct(*[F.col(c).alias(lag_fields[n]) for n, c in lags.items()]),
                     F.struct(*[F.col(c) for c in o])) if lags else None)
    aggs = [F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums] + ([last.alias("_last")] if lags else [])
    if not aggs:
        aggs = [F.count(F.lit(1)).alias("_n")]
    pieces = ranged.groupBy(_PID, *g).agg(*aggs)
    by_pid = Window.partitionBy(*g).orderBy(_PID)
    carry = pieces.select(
        _PID, *g,
        *[F.sum(f"_t_{n}").over(by_pid.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_c_{n}") for n in sums],
        *([F.lag("_last").over(by_pid).alias("_c_last")] if lags else []),
        F.row_number().over(by_pid).alias("_piece"),
    ).filter(F.col("_piece") > 1).drop("_piece")
    # Null is a group like any other, so the carry-in matches null-safely.
    carry = carry.select(*[F.col(c).alias(f"_c_key_{c}") for c in (_PID, *g)],
                         *[c for c in carry.columns if c not in (_PID, *g)])
    on = [local[c].eqNullSafe(carry[f"_c_key_{c}"]) for c in (_PID, *g)]

    out = local.join(F.broadcast(carry), on, "left")
    for name in sums:
        out = out.withColumn(name, F.col(f"_l_{name}") + F.coalesce(F.col(f"_c_{name}"), F.lit(0)))
    for name in lags:
        carried = F.col("_c_last").getField(lag_fields[name])
        out = out.withColumn(name, F.when(F.col("_l__first"), carried).otherwise(F.col(f"_l_{name}")))
    helper = [c for c in out.columns if c.startswith(("_v_", "_l_", "_c_", "_t_"))] + [_PID]
    return out.drop(*helper)


def grouped_row_number(df: DataFrame, group: str | Sequence[str], order: str | Sequence[str],
                       name: str = "rn", partitions: int | None = None, skew_safe: bool | str = "auto") -> DataFrame:
    """1-based row number per group in ``order``."""
    return grouped_scan(df, group, order, sums={name: F.lit(1).cast("bigint")}, partitions=partitions,
                        skew_safe=skew_safe)
