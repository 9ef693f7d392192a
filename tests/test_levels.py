"""The miners' levels: candidates before counting, and hot keys in several parts throughout."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from sparkmine.operators import itemsets as I
from sparkmine.operators import seqrules as SR
from sparkmine.operators import spread


def _extensions(spark, sets, masked):
    size = len(sets[0]) + 1
    if not masked:
        df = spark.createDataFrame([(list(s),) for s in sets], "items array<string>")
        return {(tuple(r.items), x) for r in I.candidate_extensions(df, size, False).collect() for x in r._allowed}
    names = sorted({x for s in sets for x in s})
    df = spark.createDataFrame([(sum(1 << names.index(x) for x in s),) for s in sets], "items long")
    rows = I.candidate_extensions(df, size, True).collect()
    decode = lambda m: [n for i, n in enumerate(names) if m >> i & 1]
    return {(tuple(decode(r["items"])), x) for r in rows for x in decode(r["_allowed"])}


@pytest.mark.parametrize("masked", [True, False])
@pytest.mark.parametrize("size", [2, 3, 4])
def test_candidates_have_frequent_subsets_only(spark, masked, size):
    rnd = random.Random(size)
    every = list(itertools.combinations("abcdefgh", size))
    frequent = set(rnd.sample(every, int(len(every) * 0.75)))
    want = {(c[:-1], c[-1]) for c in itertools.combinations("abcdefgh", size + 1)
            if all(s in frequent for s in itertools.combinations(c, size))}
    assert _extensions(spark, sorted(frequent), masked) == want and want


def test_masks_of_the_highest_items(spark):
    """Bit 61 and what lies below it: no rounding by doubles."""
    sets = [(1 << 61) | (1 << 60), (1 << 61) | (1 << 0), (1 << 60) | (1 << 0), ((1 << 53) | 1), (1 << 53) | (1 << 61)]
    rows = I.candidate_extensions(spark.createDataFrame([(s,) for s in sets], "items long"), 3, True).collect()
    assert {(r["items"], r["_allowed"]) for r in rows} == {((1 << 60) | 1, 1 << 61), ((1 << 53) | 1, 1 << 61)}


def test_fewer_occurrences_are_counted(spark):
    """Pairs that are frequent, of which few triples can be: baskets hold a and one of b to h,
    with pairs among b to h too rare."""
    rnd = random.Random(1)
    baskets = [["a", rnd.choice("bcdefgh")] for _ in range(300)] + [list("bcdefgh")] * 2 + [list("bcd")] * 30
    df = spark.createDataFrame([(b, i) for b, items in enumerate(baskets) for i in items], "basket_id long, item string")
    report = []
    found = I.frequent_itemsets(df, 0.05, report=report)
    got = {tuple(r["items"]): r.support for r in found.collect()}
    assert got[("b", "c", "d")] == 32 and ("a", "b", "c") not in got
    counted = dict(report)
    # Of b, c, d every subset is frequent: only its occurrences are counted at level 3.
    assert counted[3] == 32
    unpruned = sum(sum(1 for c in itertools.combinations(sorted(set(b)), 3) if c[:2] in got) for b in baskets)
    assert counted[3] < unpruned


@pytest.fixture
def small_parts(spark):
    spark.conf.set("sparkmine.spread.hotItems", "6")
    yield
    spark.conf.unset("sparkmine.spread.hotItems")


@pytest.fixture
def levels(monkeypatch):
    """The level tables that the miners write."""
    written = []

    def recorded(module):
        write = module.bucketed_table

        def table(df, key, buckets, name="level", aligned=False):
            out = write(df, key, buckets, name, aligned)
            written.append((name, out))
            return out

        monkeypatch.setattr(module, "bucketed_table", table)

    recorded(I)
    recorded(SR)
    return written


def _spread_over(levels, name, key):
    """For each level table: rows of the hot key, and the files that hold them."""
    for n, df in levels:
        if n == name:
            hot = df.filter(F.col("_k").startswith(f"{key}#"))
            yield hot.count(), hot.select(F.input_file_name().alias("f")).distinct().count()


@pytest.mark.parametrize("mask_items", [62, 0])
def test_a_hot_sequence_lies_in_several_files_at_every_level(spark, small_parts, levels, mask_items):
    names = [f"i{n:02d}" for n in range(24)]
    rnd = random.Random(4)
    db = [names] + [sorted(rnd.sample(names, 2)) for _ in range(30)] + [names[:4]] * 3
    rows = [(s, p, i) for s, items in enumerate(db) for p, i in enumerate(items)]
    df = spark.createDataFrame(rows, "seq_id long, pos long, item string")
    assert spread.Parts(df, "seq_id").keys == 1
    got = {(tuple(r.antecedent), tuple(r.consequent)): r.support
           for r in SR.sequential_rules(df, 0.1, 0.01, 2, 2, n=34, mask_items=mask_items).collect()}

    def support(x, y):
        return sum(set(x) | set(y) <= set(s) and max(s.index(i) for i in x) < min(s.index(i) for i in y) for s in db)

    want = {}
    for a, b in itertools.product((1, 2), (1, 2)):
        for x in itertools.combinations(names, a):
            for y in itertools.combinations(names, b):
                if not set(x) & set(y) and (n := support(x, y)) >= 4:
                    want[x, y] = n
    assert got == want
    sizes = list(_spread_over(levels, "rule_level", 0))
    assert len(sizes) >= 2 and all(files > 1 for rows, files in sizes if rows > 3)


@pytest.mark.parametrize("mask_items", [62, 0])
def test_a_hot_basket_lies_in_several_files_at_every_level(spark, small_parts, levels, mask_items):
    names = [f"i{n:02d}" for n in range(12)]
    baskets = [names, names, names] + [names[n:n + 2] for n in range(10)] * 2
    df = spark.createDataFrame([(b, i) for b, items in enumerate(baskets) for i in [*items, *items]], "basket_id long, item string")
    found = I.frequent_itemsets(df, 0.0, max_size=4, mask_items=mask_items).collect()
    got = {tuple(r["items"]): r.support for r in found}
    want = {}
    for k in (1, 2, 3, 4):
        for c in itertools.combinations(names, k):
            n = sum(set(c) <= set(b) for b in baskets)
            want |= {c: n} if n >= 2 else {}
    assert got == want
    sizes = list(_spread_over(levels, "itemset_level", 0))
    assert len(sizes) >= 2 and all(files > 1 for rows, files in sizes)
