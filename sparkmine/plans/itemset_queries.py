"""Registered itemset queries: item supports, frequent itemsets, association rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmine.operators import itemsets as I
from sparkmine.plans import views as V
from sparkmine.plans.catalog import register
from sparkmine.plans.oracle_views import with_views as W

# Fixed thresholds for the basket fixture (see FIXTURES.md section 4).
MIN_SUPPORT = 0.0033
MIN_SUPPORT_PAIRS = 0.022
MIN_CONFIDENCE = 0.1
PREDICT_ITEMS = ["Brand#1"]


def _flat(df):
    """Itemsets with the set as one comma-joined text (items are sorted)."""
    return df.select(F.array_join("items", ",").alias("itemset"), F.col("size").cast("int").alias("size"),
                     F.col("support").cast("bigint").alias("support"))


def _rules_flat(df):
    return df.select(F.array_join("antecedent", ",").alias("antecedent"),
                     F.array_join("consequent", ",").alias("consequent"),
                     F.col("support").cast("bigint").alias("support"), "confidence")


@register("item_support", W("""select item, count(*) as support from (select distinct basket_id, item from baskets)
group by item""", "baskets"))
def item_support(spark, d):
    return I.item_support(V.baskets(spark, d), "transaction")


@register("item_support_occ", W("select item, count(*) as support from baskets group by item", "baskets"))
def item_support_occ(spark, d):
    return I.item_support(V.baskets(spark, d), "occurrence")


def _levels_ctes(min_support: float, max_size: int, mode: str = "transaction") -> list[tuple[str, str]]:
    """CTEs ending in ``fi(itemset, size, support)``: frequent itemsets up to ``max_size``
    by unrolled self-joins (single items by baskets or by occurrences)."""
    thr = f"(select greatest(2, n * {min_support}) from nb)"
    singles = "tx" if mode == "transaction" else "baskets"
    parts = [f"""select item as itemset, 1 as size, count(*) as support from {singles} group by item
having count(*) >= {thr}"""]
    for k in range(2, max_size + 1):
        al = [f"t{i}" for i in range(k)]
        joins = " ".join(f"join ft {a} on {a}.basket_id = t0.basket_id and {al[i]}.item > {al[i - 1]}.item"
                         for i, a in enumerate(al) if i > 0)
        keys = ", ".join(f"{a}.item" for a in al)
        text = " || ',' || ".join(f"{a}.item" for a in al)
        parts.append(f"""select {text} as itemset, {k} as size, count(*) as support from ft t0 {joins}
group by {keys} having count(*) >= {thr}""")
    return [
        ("tx", "select distinct basket_id, item from baskets"),
        ("nb", "select count(distinct basket_id) as n from baskets"),
        ("ft", f"select * from tx where item in (select item from tx group by item having count(*) >= {thr})"),
        ("fi", "\nunion all\n".join(parts)),
    ]


def _levels_sql(min_support: float, max_size: int, mode: str = "transaction") -> str:
    return W("select * from fi", "baskets", extra=_levels_ctes(min_support, max_size, mode))


@register("itemsets_2", _levels_sql(MIN_SUPPORT_PAIRS, 3))
def itemsets_2(spark, d):
    return _flat(I.frequent_itemsets(V.baskets(spark, d), MIN_SUPPORT_PAIRS))


@register("itemsets_3", _levels_sql(MIN_SUPPORT, 4))
def itemsets_3(spark, d):
    return _flat(I.frequent_itemsets(V.baskets(spark, d), MIN_SUPPORT))


@register("itemsets_fpgrowth", _levels_sql(MIN_SUPPORT, 4))
def itemsets_fpgrowth(spark, d):
    """Same itemsets through Spark ML's FP-growth (orders are bounded baskets)."""
    return _flat(I.frequent_itemsets_fpgrowth(V.baskets(spark, d), MIN_SUPPORT))


def _rules_sql(min_support: float, max_size: int, where: str, mode: str = "transaction") -> str:
    """Rules from the unrolled itemsets: every proper subset as antecedent."""
    rule_ctes = [
        ("fl", "select itemset, size, support, string_split(itemset, ',') as items from fi"),
        ("sub", """select f.itemset, f.support, f.items, m.mask from fl f,
  (select unnest(range(1, 1 << 5)) as mask) m where f.size >= 2 and m.mask < (1 << f.size) - 1"""),
        ("r", """select array_to_string(list_filter(items, lambda x, i: ((mask >> (i - 1)) & 1) = 1), ',') as antecedent,
  array_to_string(list_filter(items, lambda x, i: ((mask >> (i - 1)) & 1) = 0), ',') as consequent,
  support from sub"""),
    ]
    return W(f"""select r.antecedent, r.consequent, r.support, r.support / a.support as confidence
from r join fi a on a.itemset = r.antecedent where {where}""", "baskets",
             extra=_levels_ctes(min_support, max_size, mode) + rule_ctes)


@register("assoc_rules", _rules_sql(MIN_SUPPORT, 4, f"r.support / a.support >= {MIN_CONFIDENCE}"))
def assoc_rules(spark, d):
    fi = I.frequent_itemsets(V.baskets(spark, d), MIN_SUPPORT)
    return _rules_flat(I.association_rules(fi, MIN_CONFIDENCE))


@register("assoc_predict", _rules_sql(MIN_SUPPORT, 4, f"""r.antecedent = '{','.join(sorted(PREDICT_ITEMS))}'
and r.support / a.support >= {MIN_CONFIDENCE}"""))
def assoc_predict(spark, d):
    fi = I.frequent_itemsets(V.baskets(spark, d), MIN_SUPPORT)
    return _rules_flat(I.predict(I.candidate_rules(fi), PREDICT_ITEMS, MIN_CONFIDENCE))


@register("itemsets_occ", _levels_sql(MIN_SUPPORT, 4, "occurrence"))
def itemsets_occ(spark, d):
    """As the reference counts: single items by occurrence, larger sets by basket."""
    return _flat(I.frequent_itemsets(V.baskets(spark, d), MIN_SUPPORT, mode="occurrence"))


@register("assoc_rules_occ", _rules_sql(MIN_SUPPORT, 4, f"r.support / a.support >= {MIN_CONFIDENCE}", "occurrence"))
def assoc_rules_occ(spark, d):
    """Rules whose one-item antecedents divide by occurrence counts, as the reference."""
    fi = I.frequent_itemsets(V.baskets(spark, d), MIN_SUPPORT, mode="occurrence")
    return _rules_flat(I.association_rules(fi, MIN_CONFIDENCE))
