"""Relational operators of the ad, sales and employee reports.

All are compositions of built-in DataFrame operators, so Catalyst keeps them in
whole-stage codegen, pushes filters into the scan and aggregates partially on the
map side before the shuffle (which also absorbs a hot grouping key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Column order of the cleaned ad records (both ETL outputs share it).
CLEAN_AD_COLUMNS = ("campaign_id", "date", "time", "keyword", "display_site", "placement", "was_clicked", "cpc")


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """Ordered limit; with a total order this plans as TakeOrderedAndProject
    (per-partition top-k, then one k-row merge), never a full sort."""
    return df.orderBy(*order).limit(k)


def normalize_keyword(c: Column | str) -> Column:
    """``UPPER(TRIM(keyword))``; trim strips blanks only, as Pig's TRIM of spaces."""
    return F.upper(F.trim(F.col(c) if isinstance(c, str) else c))


def etl_country(ads: DataFrame, country: str = "USA") -> DataFrame:
    """First ETL: keep one country, reorder fields, normalise the keyword."""
    return ads.filter(F.col("country") == country).select(
        "campaign_id", "date", "time", normalize_keyword("keyword").alias("keyword"),
        "display_site", "placement", "was_clicked", "cpc",
    )


def etl_dedupe(ads: DataFrame) -> DataFrame:
    """Second ETL: distinct records, dates with '/' separators, normalised keyword."""
    src = ads.select("campaign_id", "date", "time", "display_site", "placement", "was_clicked", "cpc", "keyword")
    return src.distinct().select(
        "campaign_id",
        F.regexp_replace("date", "-", "/").alias("date"),
        "time",
        normalize_keyword("keyword").alias("keyword"),
        "display_site", "placement", "was_clicked", "cpc",
    )


def click_cost_by(ads: DataFrame, key: str, name: str = "total_click_cost") -> DataFrame:
    """Total cost of clicked ads per key (filter before the partial aggregate)."""
    return (
        ads.filter(F.col("was_clicked") == 1)
        .groupBy(key)
        .agg(F.sum("cpc").cast("bigint").alias(name))
    )


def total_clicks(ads: DataFrame) -> DataFrame:
    return ads.filter(F.col("was_clicked") == 1).agg(F.sum("was_clicked").cast("bigint").alias("total_clicks"))


def projected_cost(ads: DataFrame, factor: int = 3) -> DataFrame:
    """``MAX(cpc) * clicks * factor`` in one pass; the click count is computed, not typed in."""
    clicks = F.count_if(F.col("was_clicked") == 1)
    return ads.agg(
        F.max("cpc").alias("max_cpc"),
        clicks.alias("clicks"),
        (F.max("cpc").cast("bigint") * clicks * F.lit(factor)).cast("bigint").alias("projected_cost"),
    )


def click_through_rate(ads: DataFrame, key: str, name: str = "ctr") -> DataFrame:
    """Clicked share per group. Pig's COUNT skips rows whose first field is null,
    hence ``count(campaign_id)``; a zero denominator gives null, not an error."""
    clicked = F.count_if(F.col("was_clicked") == 1).cast("double")
    return ads.groupBy(key).agg(F.try_divide(clicked, F.count("campaign_id").cast("double")).alias(name))


def group_count(df: DataFrame, key: str, name: str = "num", counted: str | None = None) -> DataFrame:
    """``COUNT(col)`` (nulls skipped) or ``COUNT(*)`` per group."""
    agg = F.count(counted) if counted else F.count(F.lit(1))
    return df.groupBy(key).agg(agg.alias(name))


def distinct_counts(df: DataFrame, col: str) -> DataFrame:
    """Both distinct counts: ``COUNT(DISTINCT c)`` skips null, ``distinct().count()`` keeps it."""
    return df.agg(
        F.count_distinct(col).alias("n_count_distinct"),
        (F.count_distinct(col) + F.coalesce(F.max(F.col(col).isNull().cast("int")), F.lit(0)))
        .cast("bigint").alias("n_distinct_rows"),
    )


def stats_per_group(df: DataFrame, key: str, id_col: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(
        F.count_distinct(id_col).alias("employees_count"),
        F.avg(value).alias("average_salary"),
    )


def rated_products(ratings: DataFrame, min_count: int) -> DataFrame:
    """Average rating and count per product, kept when the count reaches ``min_count``."""
    return (
        ratings.groupBy("prod_id")
        .agg(F.avg("rating").alias("avg_rating_num"), F.count(F.lit(1)).alias("num"))
        .filter(F.col("num") >= min_count)
    )


def units_per_product(details: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """``(prod_id, units)``: detail rows per product (of the given orders), aggregated
    before any product attribute is joined, so only one row per product is shuffled
    to the product join instead of every detail row."""
    d = details if orders is None else details.join(orders.select("order_id"), "order_id")
    return d.groupBy("prod_id").agg(F.count(F.lit(1)).alias("units"))


def month_range(col: str, year: int, month: int) -> Column:
    """``MONTH(c)=m AND YEAR(c)=y`` written as a half-open range, so it is a pushed-down
    parquet predicate instead of a per-row function filter."""
    start = f"{year:04d}-{month:02d}-01"
    ny, nm = (year + 1, 1) if month == 12 else (year, month + 1)
    end = f"{ny:04d}-{nm:02d}-01"
    c = F.col(col)
    return (c >= F.lit(start).cast("timestamp_ntz")) & (c < F.lit(end).cast("timestamp_ntz"))
