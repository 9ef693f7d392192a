"""The mix against a plain calculation of targets and prefix sums."""

import math
import re

import pytest
from pyspark.sql import functions as F

from sparkmine.llm import mixing
from sparkmine.llm.common import with_lookup, word_count


def plain_targets(sizes: dict) -> dict:
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    full: set = set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        total = sum(w for s, w in weight.items() if s not in full)
        target = {s: 3.0 * sizes[s] if s in full else rest * w / total for s, w in weight.items()}
        over = {s for s in sizes if s not in full and target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


def check_mix(rows, whole):
    sizes: dict = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    expected = plain_targets(sizes)
    for source, size in sizes.items():
        own = [r for r in rows if r["source"] == source]
        target = expected[source]
        assert all(r["source_size"] == size and math.isclose(r["target"], target, rel_tol=1e-9, abs_tol=1e-6) for r in own)
        taken, epochs = sum(r["taken"] for r in own), min(3, int(target // size)) if size else 0
        assert all(epochs * r["size"] <= r["taken"] <= min(3, epochs + 1) * r["size"] for r in own)
        slack = max((r["size"] for r in own), default=0) if whole else len(own)
        assert abs(taken - target) <= slack + 1


@pytest.mark.parametrize("whole", [False, True])
def test_targets_and_words_taken(documents, whole):
    docs = mixing.sized(documents).select("doc_id", "source", "size", "quality")
    mixed = mixing.mix_sources(docs, whole_documents=whole)
    rows = mixed.collect()
    assert len(rows) == documents.count()
    check_mix(rows, whole)
    again = {r["doc_id"]: r["taken"] for r in mixing.mix_sources(docs, whole_documents=whole).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}
    if not whole:  # at most one row a source is cut
        cut = [r["source"] for r in rows if r["size"] and r["taken"] % r["size"]]
        assert len(cut) == len(set(cut))


def test_order_within_a_source_is_that_of_the_keys(documents):
    """A document that is taken has a smaller key than one that is not."""
    docs = mixing.sized(documents).select("doc_id", "source", "size", "quality")
    keyed = mixing.mix_sources(docs).withColumn("key", mixing.sampling_key(F.col("doc_id"), F.col("quality"), 42))
    for source in ("src0", "src3"):
        rows = sorted(keyed.filter((F.col("source") == source) & (F.col("size") > 0)).collect(), key=lambda r: r["key"])
        shares = [r["taken"] / r["size"] for r in rows]
        assert all(a >= b - 1e-9 for a, b in zip(shares, shares[1:]))


def test_a_heavier_weight_is_taken_first_more_often(spark):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("string").alias("half"),
                                    F.lit("s").alias("source"), F.lit(10).alias("size"),
                                    F.when(F.col("id") % 2 == 0, 0.9).otherwise(0.1).alias("quality"))
    taken = mixing.mix_sources(rows, share=0.25).groupBy("half").agg(F.sum("taken")).collect()
    by_half = {r[0]: r[1] for r in taken}
    assert by_half["0"] + by_half["1"] == 10_000 and by_half["0"] > 4 * by_half["1"]


def test_odd_rows(spark, odd_documents):
    rows = mixing.mix_sources(mixing.sized(odd_documents)).collect()
    assert len(rows) == odd_documents.count()
    check_mix(rows, whole=False)
    assert mixing.mix_sources(mixing.sized(odd_documents.limit(0))).count() == 0


def test_word_count_is_that_of_the_pattern(spark):
    texts = [None, "", " ", "a", " a", "a ", " a\t b\x0b\r\nc\x0c ", " x y z", "é" * 50]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", word_count(F.col("t")).alias("n")).collect()
    assert [r["n"] for r in rows] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def test_lookup_gives_the_same_rows_beyond_the_broadcast_limit(spark, monkeypatch):
    left = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], "k string, v int")
    right = spark.createDataFrame([("a", "x"), (None, "y"), ("c", "z")], "k string, w string")
    expected = sorted(map(tuple, with_lookup(left, right, ["k"]).collect()), key=repr)
    monkeypatch.setattr("sparkmine.llm.common.LOOKUP_ROWS", 0)
    assert sorted(map(tuple, with_lookup(left, right, ["k"]).collect()), key=repr) == expected
