"""DuckDB text of the derived views (same rows as ``views.py``), for the SQL oracle.

``with_views(sql, 'ads', ...)`` prefixes a query with the CTEs it needs.
"""

from __future__ import annotations

from sparkmine.sources.lines import CATEGORIES

VIEW_SQL = {
    "ads": """select concat('C', cast(event_id % 40 as varchar)) as campaign_id,
  substring(cast(ts as varchar),1,10) as date, substring(cast(ts as varchar),12,8) as time,
  concat(' kw', regexp_extract(props,'([0-9]+)',1), ' ') as keyword,
  concat('site', cast(user_id % 20 as varchar)) as display_site,
  case when value > 10 then 'TOP' else 'SIDE' end as placement,
  case when event_type='click' then 1 else 0 end as was_clicked,
  cast(round(value*100) as int) as cpc,
  case when event_id % 3 = 0 then 'USA' else 'CAN' end as country from events""",
    "employees": """select cast(c_custkey as varchar) as emp_id, c_mktsegment as fname, c_name as lname,
  cast(c_nationkey as varchar) as state,
  case when c_custkey % 50 = 0 then null else c_mktsegment end as job_title,
  cast(floor(c_acctbal) as int) as salary from customer""",
    "products": """select p_partkey as prod_id, p_brand as brand, p_name as name,
  cast(round(p_retailprice*100) as bigint) as price,
  cast(round(p_retailprice*100) as bigint) - p_size as cost from part""",
    "order_details": "select l_orderkey as order_id, l_partkey as prod_id from lineitem",
    "sales_orders": "select o_orderkey as order_id, o_custkey as cust_id, o_orderdate as order_date from orders",
    "ratings": """select d.doc_id as post_id, d.source as prod_id, 1 + 2*l.quality + 2*(1-l.toxic) as rating,
  d.text as message from documents d join labels l on d.doc_id=l.doc_id""",
    "baskets": "select l_orderkey as basket_id, p_brand as item from lineitem join part on l_partkey=p_partkey",
    "sequences": """select concat(cast(user_id as varchar),'_',substring(cast(ts as varchar),1,10)) as seq_id,
  row_number() over (partition by user_id, substring(cast(ts as varchar),1,10) order by ts, event_id)-1 as pos,
  event_type as item from events""",
    "weekly_sequences": """select concat(cast(user_id as varchar), '_', strftime(date_trunc('week', ts), '%Y-%m-%d')) as seq_id,
  row_number() over (partition by user_id, date_trunc('week', ts) order by ts, event_id) - 1 as pos,
  concat(event_type, '_', cast(cast(regexp_extract(props, '([0-9]+)', 1) as int) % 4 as varchar)) as item
  from events""",
    "named_visits": f"""select user_id, row_number() over (partition by user_id order by ts, event_id) - 1 as pos,
  ({list(CATEGORIES)})[cast(regexp_extract(props, '([0-9]+)', 1) as int) % 12 + 1] as category from events""",
    "visits": """select user_id, row_number() over (partition by user_id order by ts, event_id)-1 as pos,
  event_type as category from events""",
    "vectors": "select vec_id, cast(embedding as double[]) as v from embeddings",
    "clean_ads": """select campaign_id, date, time, upper(trim(keyword)) as keyword, display_site, placement,
  was_clicked, cpc from ads""",
}


def with_views(sql: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``with <views>, <extra ctes> <sql>``."""
    parts = [(n, VIEW_SQL[n]) for n in names] + list(extra or [])
    ctes = ",\n".join(f"{n} as ({body})" for n, body in parts)
    return f"with {ctes}\n{sql}"
