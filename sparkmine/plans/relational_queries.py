"""Registered relational queries: the ad ETL/analysis, sales and employee reports."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sparkmine.operators import relational as R
from sparkmine.plans import views as V
from sparkmine.plans.catalog import register
from sparkmine.plans.oracle_views import with_views as W

# Fixed query parameters (the lab queries' literals, re-aimed at the driver tables).
RATING_MIN_COUNT = 15          # "num >= 50" of the lab, scaled to the fixture
REPORT_YEAR, REPORT_MONTH = 1998, 5
CUSTOMER_PREFIX = "Customer#0000001"
CUSTOMER_STATE = 3
SUPPLIER_STATE = 9


def _clean_ads(spark, d):
    """Cleaned ad records, the input of the click reports (both ETL outputs' shape)."""
    ads = V.ads(spark, d)
    return ads.select(*[R.normalize_keyword("keyword").alias("keyword") if c == "keyword" else c
                        for c in R.CLEAN_AD_COLUMNS])


def _wc(sql: str) -> str:
    return W(sql.replace("{clean}", "clean_ads"), "ads", "clean_ads")


# ---- 2.4 / 2.2: ad reports (Pig labs) -------------------------------------------------

@register("low_cost_sites", _wc("""select display_site, cast(sum(cpc) as bigint) as total_click_cost
from {clean} where was_clicked = 1 group by display_site order by total_click_cost, display_site limit 3"""))
def low_cost_sites(spark: SparkSession, d: str):
    t = R.click_cost_by(_clean_ads(spark, d), "display_site")
    return R.top_k(t, 3, F.col("total_click_cost").asc(), F.col("display_site").asc())


@register("high_cost_keywords", _wc("""select keyword, cast(sum(cpc) as bigint) as total_click_cost
from {clean} where was_clicked = 1 group by keyword order by total_click_cost desc, keyword limit 5"""))
def high_cost_keywords(spark, d):
    t = R.click_cost_by(_clean_ads(spark, d), "keyword")
    return R.top_k(t, 5, F.col("total_click_cost").desc(), F.col("keyword").asc())


@register("total_clicks", _wc("select cast(sum(was_clicked) as bigint) as total_clicks from {clean} where was_clicked = 1"))
def total_clicks(spark, d):
    return R.total_clicks(_clean_ads(spark, d))


@register("projected_cost", _wc("""select max(cpc) as max_cpc, cast(count_if(was_clicked = 1) as bigint) as clicks,
cast(cast(max(cpc) as bigint) * count_if(was_clicked = 1) * 3 as bigint) as projected_cost from {clean}"""))
def projected_cost(spark, d):
    return R.projected_cost(_clean_ads(spark, d))


@register("lowest_ctr", W("""select display_site, count_if(was_clicked = 1)::double / count(campaign_id)::double as ctr
from (select * from ads where country = 'USA') group by display_site order by ctr, display_site limit 3""", "ads"))
def lowest_ctr(spark, d):
    usa = R.etl_country(V.ads(spark, d), "USA")
    t = R.click_through_rate(usa, "display_site")
    return R.top_k(t, 3, F.col("ctr").asc(), F.col("display_site").asc())


@register("ads_country_filter", W("select * from ads where country = 'USA'", "ads"))
def ads_country_filter(spark, d):
    return V.ads(spark, d).filter(F.col("country") == "USA")


@register("ads_etl_tab", W("""select campaign_id, date, time, upper(trim(keyword)) as keyword, display_site, placement,
was_clicked, cpc from ads where country = 'USA'""", "ads"))
def ads_etl_tab(spark, d):
    return R.etl_country(V.ads(spark, d), "USA")


@register("ads_etl_comma", W("""select campaign_id, regexp_replace(date, '-', '/', 'g') as date, time,
upper(trim(keyword)) as keyword, display_site, placement, was_clicked, cpc
from (select distinct campaign_id, date, time, display_site, placement, was_clicked, cpc, keyword from ads)""", "ads"))
def ads_etl_comma(spark, d):
    return R.etl_dedupe(V.ads(spark, d))


@register("ads_distinct", W("select distinct * from (select * from ads union all select * from ads)", "ads"))
def ads_distinct(spark, d):
    a = V.ads(spark, d)
    return a.unionByName(a).distinct()


@register("fn_text", W("""select upper(trim(keyword)) as kw_upper, lower(keyword) as kw_lower, trim(keyword) as kw_trim,
regexp_replace(date, '-', '/', 'g') as date_slash, count(*) as n from ads group by all""", "ads"))
def fn_text(spark, d):
    a = V.ads(spark, d)
    return a.groupBy(
        R.normalize_keyword("keyword").alias("kw_upper"),
        F.lower("keyword").alias("kw_lower"),
        F.trim("keyword").alias("kw_trim"),
        F.regexp_replace("date", "-", "/").alias("date_slash"),
    ).agg(F.count(F.lit(1)).alias("n"))


# ---- 2.2 / 2.3 / 2.6: sales reports (Hive labs) -------------------------------------------

@register("customer_like_prefix", f"""select c_name as lname, c_mktsegment as fname from customer
where c_name like '{CUSTOMER_PREFIX}%' and c_nationkey = {CUSTOMER_STATE}""")
def customer_like_prefix(spark, d):
    c = V.table(spark, d, "customer")
    return c.filter(F.col("c_name").like(f"{CUSTOMER_PREFIX}%") & (F.col("c_nationkey") == CUSTOMER_STATE)).select(
        F.col("c_name").alias("lname"), F.col("c_mktsegment").alias("fname"))


@register("top_priced", W("select price, brand, name from products order by price desc, prod_id limit 3", "products"))
def top_priced(spark, d):
    p = V.products(spark, d)
    return R.top_k(p, 3, F.col("price").desc(), F.col("prod_id").asc()).select("price", "brand", "name")


_SALES = ("from order_details od join products p on p.prod_id = od.prod_id "
          "join sales_orders o on od.order_id = o.order_id "
          f"where month(o.order_date) = {REPORT_MONTH} and year(o.order_date) = {REPORT_YEAR}")


def _month_orders(spark, d):
    return V.sales_orders(spark, d).filter(R.month_range("order_date", REPORT_YEAR, REPORT_MONTH))


def _month_units(spark, d):
    """Units per product sold in the report month, joined to price and cost."""
    units = R.units_per_product(V.order_details(spark, d), _month_orders(spark, d))
    return units.join(V.products(spark, d), "prod_id")


@register("verify_order", W(f"""select o.order_id, c.c_name as lname, c.c_mktsegment as fname, o.order_date, p.name
from order_details od join products p on p.prod_id = od.prod_id
join sales_orders o on od.order_id = o.order_id join customer c on c.c_custkey = o.cust_id
where month(o.order_date) = {REPORT_MONTH} and year(o.order_date) = {REPORT_YEAR} and c.c_name like '{CUSTOMER_PREFIX}%'""",
                                  "order_details", "products", "sales_orders"))
def verify_order(spark, d):
    c = V.table(spark, d, "customer").filter(F.col("c_name").like(f"{CUSTOMER_PREFIX}%")).select(
        F.col("c_custkey").alias("cust_id"), F.col("c_name").alias("lname"), F.col("c_mktsegment").alias("fname"))
    o = _month_orders(spark, d).join(c, "cust_id")
    s = V.order_details(spark, d).join(o, "order_id").join(V.products(spark, d), "prod_id")
    return s.select("order_id", "lname", "fname", "order_date", "name")


@register("top_products", W("""select name, count(name) as total from products p join order_details od on p.prod_id = od.prod_id
group by name order by total desc, name limit 3""", "products", "order_details"))
def top_products(spark, d):
    units = R.units_per_product(V.order_details(spark, d))
    j = units.join(V.products(spark, d), "prod_id").filter(F.col("name").isNotNull())
    t = j.groupBy("name").agg(F.sum("units").alias("total"))
    return R.top_k(t, 3, F.col("total").desc(), F.col("name").asc())


@register("monthly_revenue", W(f"select cast(sum(price) as bigint) as total {_SALES}",
                               "order_details", "products", "sales_orders"))
def monthly_revenue(spark, d):
    return _month_units(spark, d).agg(F.sum(F.col("price") * F.col("units")).cast("bigint").alias("total"))


@register("monthly_profit", W(f"select cast(sum(price) - sum(cost) as bigint) as total {_SALES}",
                              "order_details", "products", "sales_orders"))
def monthly_profit(spark, d):
    u = _month_units(spark, d)
    return u.agg((F.sum(F.col("price") * F.col("units")) - F.sum(F.col("cost") * F.col("units")))
                 .cast("bigint").alias("total"))


@register("monthly_profit_text", W(f"select printf('$%.2f', (sum(price) - sum(cost)) / 100) as total {_SALES}",
                                   "order_details", "products", "sales_orders"))
def monthly_profit_text(spark, d):
    u = _month_units(spark, d)
    profit = F.sum(F.col("price") * F.col("units")) - F.sum(F.col("cost") * F.col("units"))
    return u.agg(F.format_string("$%.2f", profit / F.lit(100.0)).alias("total"))


@register("customer_count_distinct", W("select count(distinct cust_id) as total from sales_orders", "sales_orders"))
def customer_count_distinct(spark, d):
    return V.sales_orders(spark, d).agg(F.count_distinct("cust_id").alias("total"))


@register("top_states", """select cast(c_nationkey as varchar) as state, count(c_nationkey) as num from customer
group by c_nationkey order by num desc, state limit 10""")
def top_states(spark, d):
    c = V.table(spark, d, "customer").select(F.col("c_nationkey").cast("string").alias("state"))
    return R.top_k(R.group_count(c, "state", counted="state"), 10, F.col("num").desc(), F.col("state").asc())


@register("supplier_count", f"select count(*) as n from supplier where s_nationkey = {SUPPLIER_STATE}")
def supplier_count(spark, d):
    s = V.table(spark, d, "supplier").filter(F.col("s_nationkey") == SUPPLIER_STATE)
    return s.agg(F.count(F.lit(1)).alias("n"))


@register("product_lookup", W("select * from products where prod_id = 7", "products"))
def product_lookup(spark, d):
    return V.products(spark, d).filter(F.col("prod_id") == 7)


@register("product_like", W("select * from products where name like '%red%' and brand = 'Brand#17'", "products"))
def product_like(spark, d):
    p = V.products(spark, d)
    return p.filter(F.col("name").like("%red%") & (F.col("brand") == "Brand#17"))


# ---- employees (DataFrame / SQL lab, Hive external table) -----------------------------------

@register("employees_sorted_limit", W("select * from employees order by fname asc, lname desc limit 5", "employees"))
def employees_sorted_limit(spark, d):
    return R.top_k(V.employees(spark, d), 5, F.col("fname").asc(), F.col("lname").desc())


@register("employees_sorted_sql", W("select * from employees order by fname asc, lname desc", "employees"))
def employees_sorted_sql(spark, d):
    V.employees(spark, d).createOrReplaceTempView("employees")
    return spark.sql("SELECT * FROM employees ORDER BY fname ASC, lname DESC")


@register("job_title_distinct_rows", W("""select count(distinct job_title) as n_count_distinct,
(select count(*) from (select distinct job_title from employees)) as n_distinct_rows from employees""", "employees"))
def job_title_distinct_rows(spark, d):
    return R.distinct_counts(V.employees(spark, d), "job_title")


@register("top_job_titles", W("""select job_title, count(*) as num from employees group by job_title
order by num desc, job_title asc nulls first limit 3""", "employees"))
def top_job_titles(spark, d):
    t = R.group_count(V.employees(spark, d), "job_title")
    return R.top_k(t, 3, F.col("num").desc(), F.col("job_title").asc_nulls_first())


_JOB_STATS_SQL = W("""select job_title, count(distinct emp_id) as employees_count, avg(salary) as average_salary
from employees group by job_title""", "employees")


@register("job_title_stats", _JOB_STATS_SQL)
def job_title_stats(spark, d):
    return R.stats_per_group(V.employees(spark, d), "job_title", "emp_id", "salary")


@register("job_title_stats_sql", _JOB_STATS_SQL)
def job_title_stats_sql(spark, d):
    V.employees(spark, d).createOrReplaceTempView("employees")
    return spark.sql("""SELECT job_title, COUNT(DISTINCT emp_id) AS employees_count,
        AVG(salary) AS average_salary FROM employees GROUP BY job_title""")


# ---- ratings (sentiment lab) ---------------------------------------------------------------

_RATED = f"""(select prod_id, avg(rating) as avg_rating_num, count(*) as num from ratings group by prod_id) rated
where num >= {RATING_MIN_COUNT}"""


@register("best_rated", W(f"""select prod_id, format('{{:,.2f}}', avg_rating_num) as avg_rating from {_RATED}
order by avg_rating_num desc, prod_id limit 1""", "ratings"))
def best_rated(spark, d):
    t = R.rated_products(V.ratings(spark, d), RATING_MIN_COUNT)
    top = R.top_k(t, 1, F.col("avg_rating_num").desc(), F.col("prod_id").asc())
    return top.select("prod_id", F.format_number("avg_rating_num", 2).alias("avg_rating"))


@register("worst_rated", W(f"""select prod_id, format('{{:,.2f}}', avg_rating_num) as avg_rating from {_RATED}
order by avg_rating_num asc, prod_id limit 1""", "ratings"))
def worst_rated(spark, d):
    t = R.rated_products(V.ratings(spark, d), RATING_MIN_COUNT)
    top = R.top_k(t, 1, F.col("avg_rating_num").asc(), F.col("prod_id").asc())
    return top.select("prod_id", F.format_number("avg_rating_num", 2).alias("avg_rating"))


@register("message_like_limit", W("""select post_id, message from ratings where prod_id = 'src3' and message like '%the%'
order by post_id limit 3""", "ratings"))
def message_like_limit(spark, d):
    r = V.ratings(spark, d).filter((F.col("prod_id") == "src3") & F.col("message").like("%the%"))
    return R.top_k(r.select("post_id", "message"), 3, F.col("post_id").asc())


@register("message_like_distinct", W("""select distinct message from ratings where prod_id = 'src3' and message like '%ou%'""",
                                     "ratings"))
def message_like_distinct(spark, d):
    r = V.ratings(spark, d).filter((F.col("prod_id") == "src3") & F.col("message").like("%ou%"))
    return r.select("message").distinct()
