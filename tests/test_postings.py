"""Posting words against plain sets, and sketches of n-grams against exact counts."""

from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmine.functions import sketch
from sparkmine.functions import text as T
from sparkmine.operators import postings as P


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    out = [(f"s{s}", f"i{i}") for s in range(500) for i in range(8) if rng.random() < (1.0 if i == 0 else 0.4 / (i + 1))]
    out += [(f"s{s}", "i1") for s in range(50)]  # repeats
    out += [("hot", f"j{k}") for k in range(300)]  # a sequence of very many items
    return [*out, (None, "i2"), ("s1", None)]


def test_posting_words_hold_plain_sets(spark, rows):
    df = spark.createDataFrame(rows, "seq_id string, item string").repartition(3)
    sets = defaultdict(set)
    for s, i in rows:
        if s is not None:
            sets[i].add(s)
    numbers = P.number_sequences(df)
    assert numbers.count() == len(set().union(*sets.values())) == numbers.select("no").distinct().count()
    words = P.posting_words(df, numbers)
    # One row at most for 64 sequences and an item, however many have it.
    assert words.groupBy("word", "item").count().filter("count > 1").isEmpty()
    assert words.filter("item = 'i0'").count() < 501 / 20
    back = defaultdict(set)
    for r in P.sequences_of(words, numbers).collect():
        assert r.seq_id not in back[r.item]
        back[r.item].add(r.seq_id)
    assert back == sets
    named = sorted(i for i in sets if i is not None and i[0] == "i")
    pairs = {(r.item_a, r.item_b): r.n_seq for r in P.pair_counts(words.filter("item like 'i%'")).collect()}
    assert pairs == {(a, b): len(sets[a] & sets[b]) for a, b in combinations(named, 2) if sets[a] & sets[b]}
    asked = [["i0"], ["i0", "i1"], ["i1", "i2", "i3"], ["i0", "none"], ["j0", "j299"], []]
    df = spark.createDataFrame(list(enumerate(asked)), "set_id int, items array<string>")
    found = {r.set_id: r.n_seq for r in P.set_counts(P.common_words(words, df), "set_id").collect()}
    want = {n: len(set.intersection(*(sets.get(i, set()) for i in items))) for n, items in enumerate(asked) if items}
    assert found == {n: c for n, c in want.items() if c}


def test_pair_join_of_words_has_no_exchange_before_it(spark, rows):
    df = spark.createDataFrame(rows, "seq_id string, item string")
    words = P.posting_words(df, P.number_sequences(df))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = P.pair_counts(words)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1  # that of the counts


def test_empty_postings(spark):
    none = spark.createDataFrame([], "seq_id string, item string")
    words = P.posting_words(none, P.number_sequences(none))
    assert words.count() == 0 and P.pair_counts(words).count() == 0


# ---- sketches ------------------------------------------------------------------------------


@pytest.mark.parametrize("capacity,held", [(8, 500_000), (40, 100), (5000, 500_000)])
def test_sketches_keep_their_bounds(spark, monkeypatch, capacity, held):
    monkeypatch.setattr(sketch, "HELD", held)
    rng = np.random.default_rng(6)
    rows = [("hot" if n % 3 else f"g{n % 5}", [f"w{int(w)}" for w in rng.zipf(1.5, size=int(rng.integers(0, 9))) % 900]) for n in range(3000)]
    rows += [(None, ["x", "x", None]), ("empty", []), ("none", None)]
    truth = defaultdict(Counter)
    for g, items in rows:
        truth[g].update(i for i in items or [] if i is not None)
    df = spark.createDataFrame(rows, "g string, items array<string>").repartition(7)
    found = defaultdict(dict)
    lost = {}
    for r in sketch.heavy_hitters(df, "g", F.col("items"), capacity).collect():
        found[r.g][r.item], lost[r.g] = r.n, r.lost
    assert set(found) == {g for g, c in truth.items() if c}
    for g, c in truth.items():
        if not c:
            continue
        total = sum(c.values())
        assert len(found[g]) <= capacity and lost[g] <= total / (capacity + 1)
        assert all(n <= c[i] <= n + lost[g] for i, n in found[g].items())
        assert {i for i, n in c.items() if n > lost[g]} <= set(found[g])
        if len(c) <= capacity:
            assert found[g] == c and lost[g] == 0


def test_estimated_ngrams_are_arrays(spark):
    df = spark.createDataFrame([("a", "big cat. big cat! the big cat"), ("a", "small dog"), ("b", "one"), (None, "x y")], "g string, t string")
    found = T.ngrams_estimated(df, "g", T.plain_sentences("t"), 2, 2).collect()
    got = sorted(((r.g, r.ngram, r.estfrequency, r.error) for r in found), key=repr)
    assert got == sorted([("a", ["big", "cat"], 3.0, 0.0), ("a", ["small", "dog"], 1.0, 0.0), (None, ["x", "y"], 1.0, 0.0)], key=repr)
    exact = T.ngrams_estimated(df, "g", T.sentences("t"), 2, 2).count()
    assert exact == 3
