"""Fingerprints, links and groups against brute force."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from sparkmine.llm import simhash
from sparkmine.llm.components import connected_components


def plain_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    bits = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, seed=42)
        for i in range(64):
            bits[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * bits[i] > len(grams))


def plain_groups(prints: dict, distance=2) -> dict:
    """{key: smallest key reachable}, all pairs compared."""
    root = {k: k for k in prints}

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    keys = list(prints)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {k: find(k) for k in keys}


def test_documents(documents):
    rows = simhash.near_duplicates(documents).collect()
    texts = {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r["doc_id"]: r["component_id"] for r in rows} == plain_groups(prints)
    assert len(rows) == len(texts)


def signed(v):
    return v - (1 << 64) if v >> 63 else v


@pytest.mark.parametrize(("distance", "hot"), [(0, 512), (1, 512), (2, 512), (2, 1), (2, 3)])
def test_links_have_the_components_of_all_pairs(spark, distance, hot):
    """Chains and families of near copies; with a small ``hot`` they take the other way."""
    rng = random.Random(distance)
    prints = {0, (1 << 64) - 1, 1 << 63, 1}
    for _ in range(12):
        p = rng.getrandbits(64)
        for _ in range(10):
            prints.add(p)
            for _ in range(rng.choice((1, 1, 2, 2, 3))):
                p ^= 1 << rng.randrange(64)
    prints = {signed(p): p for p in prints}
    fps = spark.createDataFrame([(p,) for p in prints], "fp long")
    links = simhash.hamming_links(fps, distance, hot)
    assert all((prints[r["a"]] ^ prints[r["b"]]).bit_count() <= distance for r in links.collect())
    found = {r["node"]: r["root"] for r in connected_components(links).collect()}
    assert {p: found.get(p, p) for p in prints} == plain_groups(prints, distance)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (300, 200), (200, 300)]
    rows = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    expected = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 300: 200}
    assert {r["node"]: r["root"] for r in rows} == expected and len(rows) == len(expected)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(odd_documents):
    rows = simhash.near_duplicates(odd_documents, keep=("text",)).collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        assert r["fingerprint"] == f"{plain_fingerprint(r['text']):016x}"
    group = {r["doc_id"]: r["component_id"] for r in rows}
    assert group[2] == group[3] == group[4] == 2 and group[1] == 1 and group[None] is None
    assert simhash.near_duplicates(odd_documents.limit(0)).count() == 0


def test_a_long_text_is_hashed_in_parts(monkeypatch):
    text = " ".join(random.Random(1).choices(["a", "bb", "c", "dd", "e"], k=500))
    whole = simhash.simhash(text.encode(), 3)
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 7)
    assert simhash.simhash(text.encode(), 3) == whole == signed(plain_fingerprint(text))


def test_repeated_rows_share_a_group(spark):
    docs = spark.createDataFrame([(9, "one two three four"), (3, "ONE two\tthree  four"), (9, "one two three four")], "doc_id long, text string")
    assert {r["component_id"] for r in simhash.near_duplicates(docs).collect()} == {3}
    assert simhash.near_duplicates(docs.withColumn("text", F.lit(None).cast("string"))).filter("fingerprint = '0000000000000000'").count() == 3
