"""Golden values and cross-query consistency (the reference keeps outputs, not inputs)."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from sparkmine.operators import relational as R

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_short_words_are_the_full_counts_filtered(spark):
    full = {r.word: r["count"] for r in E.queries()["word_count"](spark, SF).collect()}
    short = {r.word: r["count"] for r in E.queries()["word_count_short"](spark, SF).collect()}
    assert short == {w: c for w, c in full.items() if len(w) <= 5}
    assert "" in short  # empty words are kept and counted


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_average_length_is_the_weighted_mean_of_counts(spark):
    full = {r.word: r["count"] for r in E.queries()["word_count"](spark, SF).collect()}
    avg = {r.letter: r.avg_length for r in E.queries()["avg_word_length"](spark, SF).collect()}
    letters = {}
    for w, c in full.items():
        if w and ("a" <= w[0] <= "z" or "A" <= w[0] <= "Z"):
            n, tot = letters.get(w[0], (0, 0))
            letters[w[0]] = (n + c, tot + c * len(w))
    assert set(avg) == set(letters)
    for k, (n, tot) in letters.items():
        assert avg[k] == pytest.approx(tot / n)


def test_profit_text_golden(spark):
    row = spark.range(1).select(F.format_string("$%.2f", F.lit(193215556) / F.lit(100.0)).alias("t")).first()
    assert row.t == "$1932155.56"


def test_projected_cost_formula(spark):
    # 18,243 clicks at a maximum cost per click of 160, three times over: 8,756,640.
    rows = [("c", 1, 160)] + [("c", 1, 10)] * 18242 + [("c", 0, 5)]
    df = spark.createDataFrame(rows, "campaign_id string, was_clicked int, cpc int")
    r = R.projected_cost(df).first()
    assert (r.clicks, r.max_cpc, r.projected_cost) == (18243, 160, 8756640)


def test_formatted_average_orders_by_number_not_text(spark):
    rows = [("a", 9.5)] * 20 + [("b", 10.5)] * 20
    df = spark.createDataFrame(rows, "prod_id string, rating double")
    best = R.top_k(R.rated_products(df, 15), 1, F.col("avg_rating_num").desc(), F.col("prod_id").asc()).first()
    assert best.prod_id == "b"  # as text, '9.50' > '10.50'
