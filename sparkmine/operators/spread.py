"""Joins on a key of which some values have very many rows on one side, made so that these
values are spread over many tasks and all others stay where they are (in buckets)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.session import broadcast_if_small, cached

HOT_ITEMS = 4096  # rows of one key in the small side from which on it is spread
SALTS = 64


def hot_limit(spark: SparkSession) -> int:
    """``HOT_ITEMS``, or what session conf ``sparkmine.spread.hotItems`` sets."""
    return int(spark.conf.get("sparkmine.spread.hotItems", str(HOT_ITEMS)))


def hot_keys(rows: DataFrame, key: str) -> DataFrame | None:
    """The keys with over ``hot_limit`` rows; None if there are none."""
    limit = hot_limit(rows.sparkSession)
    hot = cached(rows.groupBy(key).count().filter(F.col("count") > limit).select(key))
    return None if hot.isEmpty() else hot


def spread_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """``left.join(right, key)``; the rows of ``left`` with a hot key are dealt to SALTS
    tasks by a hash of themselves, and only those keys' rows of ``right`` are copied."""
    if hot is None:
        return left.join(right, key)
    cold = left.join(hot, key, "left_anti").join(right, key)
    dealt = left.join(hot, key, "left_semi").withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int"))
    copies = right.join(hot, key, "left_semi").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return cold.unionByName(dealt.join(copies, [key, "_salt"]).drop("_salt"))


class Parts:
    """A bucket key ``_k`` of (key, part) for level tables: a key with over ``HOT_ITEMS`` rows
    of ``rows`` has one part for each ``HOT_ITEMS`` of them, any other key one. Rows that are
    dealt to a part stay in it from level to level, as do those that they grow into, so a
    hot key's rows lie in several buckets, files and tasks at every level, and joins on
    ``_k`` still run from bucket to bucket. Without hot keys ``_k`` is the key itself."""

    def __init__(self, rows: DataFrame, key: str):
        limit = hot_limit(rows.sparkSession)
        counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > limit)
        hot = cached(counts.select(key, F.ceil(F.col("_rows") / limit).cast("int").alias("_parts")))
        self.key, self.keys = key, hot.count()
        self.hot = hot if self.keys else None

    def _with_parts(self, rows: DataFrame) -> DataFrame:
        found = rows.join(broadcast_if_small(self.hot, self.keys, 48), self.key, "left")
        return found.withColumn("_parts", F.coalesce("_parts", F.lit(1)))

    def _named(self, rows: DataFrame, part: Column) -> DataFrame:
        return rows.withColumn("_k", F.concat_ws("#", F.col(self.key).cast("string"), part.cast("string"))).drop(self.key, "_parts")

    def dealt(self, rows: DataFrame, *by: str) -> DataFrame:
        """Each row in one part of its key, by a hash of the columns ``by``."""
        if self.hot is None:
            return rows.withColumnRenamed(self.key, "_k")
        return self._named(self._with_parts(rows), F.pmod(F.xxhash64(*by), F.col("_parts")))

    def copied(self, rows: DataFrame) -> DataFrame:
        """Each row in all parts of its key."""
        if self.hot is None:
            return rows.withColumnRenamed(self.key, "_k")
        rows = self._with_parts(rows).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        return self._named(rows, F.col("_part")).drop("_part")
