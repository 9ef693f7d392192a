"""Frequent itemsets and association rules against brute force."""

import itertools
import random

import pytest

from sparkmine.operators import itemsets as I


def _baskets(spark, baskets):
    rows = [(b, it) for b, items in enumerate(baskets) for it in items]
    return spark.createDataFrame(rows, "basket_id long, item string")


def test_repeat_in_basket(spark):
    df = _baskets(spark, [["a", "a", "b"]])
    occ = {r.item: r.support for r in I.item_support(df, "occurrence").collect()}
    tx = {r.item: r.support for r in I.item_support(df, "transaction").collect()}
    assert occ["a"] == 2 and tx["a"] == 1


def _brute(baskets, min_support, mode):
    n = len(baskets)
    thr = max(2.0, n * min_support)
    items = sorted({i for b in baskets for i in b})
    out = {}
    for k in range(1, len(items) + 1):
        found = False
        for combo in itertools.combinations(items, k):
            if k == 1 and mode == "occurrence":
                sup = sum(b.count(combo[0]) for b in baskets)
            else:
                sup = sum(1 for b in baskets if set(combo) <= set(b))
            if sup >= thr:
                out[combo] = sup
                found = True
        if not found and k > 1:
            break
    return out


@pytest.mark.parametrize("mask_items", [I.MASK_ITEMS, 0])
def test_random_itemsets_and_rules(spark, mask_items):
    """Bit-mask sets (few frequent items) and array sets (forced) against brute force."""
    rnd = random.Random(3)
    baskets = [[rnd.choice("abcdefg") for _ in range(rnd.randint(0, 6))] or [""] for _ in range(120)]
    for mode in ("transaction", "occurrence"):
        fi = I.frequent_itemsets(_baskets(spark, baskets), 0.05, mode=mode, n=len(baskets), mask_items=mask_items)
        got = {tuple(r["items"]): r.support for r in fi.collect()}
        exp = _brute(baskets, 0.05, mode)
        assert got == exp
        rules = I.association_rules(fi, 0.3).collect()
        exp_rules = set()
        for s, sup in exp.items():
            for k in range(1, len(s)):
                for a in itertools.combinations(s, k):
                    conf = sup / exp[a]
                    if conf >= 0.3:
                        exp_rules.add((a, tuple(x for x in s if x not in a), sup, round(conf, 12)))
        assert {(tuple(r.antecedent), tuple(r.consequent), r.support, round(r.confidence, 12))
                for r in rules} == exp_rules


def test_predict(spark):
    baskets = [["a", "b"], ["a", "b"], ["a", "c"], ["b", "a", "c"]]
    fi = I.frequent_itemsets(_baskets(spark, baskets), 0.5)
    got = I.predict(I.candidate_rules(fi), ["b"], 0.0).collect()
    assert {(tuple(r.antecedent), tuple(r.consequent)) for r in got} == {(("b",), ("a",))}


def test_threshold_floor_of_two():
    assert I.support_threshold(10, 0.01) == 2.0
    assert I.support_threshold(1000, 0.01) == 10.0


def test_matches_spark_fpgrowth(spark):
    """Cross-check with Spark ML's FP-growth (transaction support, threshold as a fraction)."""
    from pyspark.ml.fpm import FPGrowth
    from pyspark.sql import functions as F

    rnd = random.Random(21)
    baskets = [sorted(set(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 6)))) for _ in range(400)]
    df = _baskets(spark, baskets)
    ours = {(tuple(r["items"]), r.support) for r in I.frequent_itemsets(df, 0.05, n=len(baskets)).collect()}
    tx = spark.createDataFrame([(b,) for b in baskets], "items array<string>")
    model = FPGrowth(itemsCol="items", minSupport=0.05).fit(tx)
    theirs = {(tuple(sorted(r["items"])), r.freq) for r in model.freqItemsets.select("items", "freq").collect()}
    assert ours == theirs


def test_predict_batch(spark):
    baskets = [["a", "b"], ["a", "b"], ["a", "c"], ["b", "a", "c"]]
    fi = I.frequent_itemsets(_baskets(spark, baskets), 0.5)
    q = spark.createDataFrame([(1, ["b"]), (2, ["b", "a", "b"])], "qid long, items array<string>")
    got = {(r.qid, tuple(r.consequent)) for r in I.predict_batch(I.candidate_rules(fi), q, 0.0).collect()}
    assert (1, ("a",)) in got and all(qid == 1 for qid, _ in got)
