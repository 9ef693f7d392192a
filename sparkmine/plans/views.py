"""Derived input views over the driver's parquet tables.

Each view is the Spark form of a relation the reference reads (ad clicks, employees,
products, ratings, baskets, sequences, ...). Every view is a lazy projection over a
parquet scan, so Catalyst prunes columns and pushes filters into the scan of the
underlying table. The DuckDB text of the same views lives in ``oracle_views``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.operators.sequences import with_positions
from sparkmine.session import shuffle_partitions
from sparkmine.sources.lines import CATEGORIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts_text(c: str) -> Column:
    return F.col(c).cast("string")


def ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad impressions and clicks: (campaign_id, date, time, keyword, display_site,
    placement, was_clicked, cpc, country). ``keyword`` keeps blanks on purpose."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("C"), (F.col("event_id") % 40).cast("string")).alias("campaign_id"),
        F.substring(_ts_text("ts"), 1, 10).alias("date"),
        F.substring(_ts_text("ts"), 12, 8).alias("time"),
        F.concat(F.lit(" kw"), F.regexp_extract("props", "([0-9]+)", 1), F.lit(" ")).alias("keyword"),
        F.concat(F.lit("site"), (F.col("user_id") % 20).cast("string")).alias("display_site"),
        F.when(F.col("value") > 10, "TOP").otherwise("SIDE").alias("placement"),
        F.when(F.col("event_type") == "click", 1).otherwise(0).alias("was_clicked"),
        F.round(F.col("value") * 100).cast("int").alias("cpc"),
        F.when(F.col("event_id") % 3 == 0, "USA").otherwise("CAN").alias("country"),
    )


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("emp_id"),
        F.col("c_mktsegment").alias("fname"),
        F.col("c_name").alias("lname"),
        F.col("c_nationkey").cast("string").alias("state"),
        F.when(F.col("c_custkey") % 50 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("c_mktsegment"))
        .alias("job_title"),
        F.floor("c_acctbal").cast("int").alias("salary"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    price = F.round(F.col("p_retailprice") * 100).cast("bigint")
    return p.select(
        F.col("p_partkey").alias("prod_id"),
        F.col("p_brand").alias("brand"),
        F.col("p_name").alias("name"),
        price.alias("price"),
        (price - F.col("p_size")).alias("cost"),
    )


def order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("prod_id"))


def sales_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("cust_id"),
        F.col("o_orderdate").alias("order_date"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id")
    return j.select(
        F.col("doc_id").alias("post_id"),
        F.col("source").alias("prod_id"),
        (1 + 2 * F.col("quality") + 2 * (1 - F.col("toxic"))).alias("rating"),
        F.col("text").alias("message"),
    )


def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long basket table (basket_id, item); repeats of an item in a basket are kept."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_orderkey").alias("basket_id"), F.col("p_brand").alias("item")
    )


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by (user, day), in no order: (seq_id, ts, event_id, item)."""
    ev = table(spark, sf_dir, "events")
    day = F.substring(_ts_text("ts"), 1, 10)
    return ev.select(
        F.concat(F.col("user_id").cast("string"), F.lit("_"), day).alias("seq_id"),
        "ts",
        "event_id",
        F.col("event_type").alias("item"),
    )


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sequence per (user, day): (seq_id, pos, item)."""
    return with_positions(daily_events(spark, sf_dir), "seq_id", ["ts", "event_id"]).select("seq_id", "pos", "item")


def weekly_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sequence per user and week, named by its Monday; item = event type and the
    props number mod 4."""
    ev = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int") % 4
    monday = F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd")
    seq = ev.select(
        F.concat(F.col("user_id").cast("string"), F.lit("_"), monday).alias("seq_id"),
        "ts", "event_id",
        F.concat(F.col("event_type"), F.lit("_"), k.cast("string")).alias("item"),
    )
    # Dealt by number: AQE doesn't join the parts, which are sorted and go on to be bucketed.
    seq = seq.repartition(shuffle_partitions(spark), "seq_id")
    return with_positions(seq, "seq_id", ["ts", "event_id"]).select("seq_id", "pos", "item")


def visit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits in no order: (user_id, ts, event_id, category)."""
    return table(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.col("event_type").alias("category"))


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One clickstream per user: (user_id, pos, category)."""
    return with_positions(visit_events(spark, sf_dir), "user_id", ["ts", "event_id"]).select("user_id", "pos", "category")


def named_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``visits``, with categories out of the 17 names (12 of them occur)."""
    names = F.array(*[F.lit(c) for c in CATEGORIES])
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int") % 12
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.get(names, k).alias("category"))
    return with_positions(ev, "user_id", ["ts", "event_id"]).select("user_id", "pos", "category")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
