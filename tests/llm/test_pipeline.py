"""The registered queries and the pipeline: SQL where there is one, plain calculations
where there isn't, and the pipeline's stages on odd rows."""

import hashlib
import os
import sys

import duckdb
import pytest
import tiktoken
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__ as E
import corpus_pipeline
from sparkmine.llm import queries, quality
from sparkmine.llm.common import materialised

from test_simhash import plain_fingerprint, plain_groups

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


def test_every_operator_is_registered_once():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()
    assert set(queries.ORACLE) <= set(E.oracle_sql()) & set(E.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, sf, con, name):
    df = queries.QUERIES[name](spark, sf)
    res = con.sql(queries.ORACLE[name])
    columns = sorted(df.columns)
    assert columns == sorted(res.columns)
    expected = [dict(zip(res.columns, r)) for r in res.fetchall()]
    assert sorted(([r[c] for c in columns] for r in df.collect()), key=repr) == sorted(([r[c] for c in columns] for r in expected), key=repr)


def test_near_dedup_and_encoding_queries(spark, sf, documents):
    texts = {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}
    groups = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.QUERIES["op5_simhash_near_dedup"](spark, sf).collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    roots = plain_groups(prints)
    assert groups == {i: (f"{p:016x}", roots[i]) for i, p in prints.items()}
    ranks, pattern = queries.vocabulary()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks.of, special_tokens={})
    for r in queries.QUERIES["op4_byte_bpe"](spark, sf).collect():
        ids = library.encode_ordinary(texts[r["doc_id"]])
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(packed).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_stages(spark, sf, documents):
    """Each stage against what its operator decides about the rows it gets."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "secrets", "mixing", "encoding"]
    by_name = dict(corpus_pipeline.STAGES)

    def stage(name, docs):
        out = materialised(by_name[name](spark, docs, sf), f"test-{name}")
        assert name == "encoding" or out.schema.simpleString() == documents.schema.simpleString()
        return out

    good = stage("quality", documents)
    weights = queries.quality_weights(spark, documents, sf)
    scored = {r["doc_id"] for r in quality.classify(documents, weights).filter("predicted = 1").collect()}
    assert {r["doc_id"] for r in good.collect()} == scored and good.count() < documents.count()

    single = stage("near_dedup", good)
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in good.collect()}
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(set(plain_groups(prints).values()))

    clean = stage("secrets", single)
    was = {r["doc_id"]: r for r in single.collect()}
    now = {r["doc_id"]: r for r in clean.collect()}
    assert set(was) == set(now) and any("[SECRET]" in r["text"] for r in now.values())
    assert all(r["n_chars"] == len(r["text"]) and (r["text"] == was[i]["text"] or "[SECRET]" in r["text"]) for i, r in now.items())

    mixed = stage("mixing", clean)
    copies: dict = {}
    for r in mixed.collect():
        assert r == now[r["doc_id"]]
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    assert max(copies.values()) <= 3 and set(copies) < set(now)

    last = stage("encoding", mixed)
    ranks, pattern = queries.vocabulary()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks.of, special_tokens={})
    rows = last.collect()
    assert len(rows) == mixed.count() and all(r["ids"] == library.encode_ordinary(now[r["doc_id"]]["text"]) for r in rows)


def test_stages_on_odd_rows(spark, sf, odd_documents):
    """Nulls, empty and long texts, repeated rows and columns with clashing names."""
    docs = materialised(odd_documents, "odd")
    rows = docs.collect()
    sizes = {}
    for name, stage in corpus_pipeline.STAGES:
        for some in (docs, docs.limit(0)):
            out = materialised(stage(spark, some, sf), f"odd-{name}")
            assert name == "encoding" or out.columns == docs.columns
            sizes[name, some is docs] = out.count()
    assert [sizes[n, False] for n, _ in corpus_pipeline.STAGES] == [0] * 5
    assert sizes["near_dedup", True] == len({(r["doc_id"]) for r in rows}) - 2  # 1 once; 2, 3 and 4 are one group
    assert sizes["secrets", True] == sizes["encoding", True] == len(rows)


def test_near_dedup_keeps_every_group_of_null_ids(spark, sf):
    fox, sea = "the quick brown fox jumps over the lazy dog", "a calm sea and seven small boats far from any shore"
    rows = [(None, fox, "a"), (None, fox, "b"), (None, sea, "a"), (4, "some other words that nobody else has used", "a"), (None, "", "a"), (7, "", "a")]
    docs = materialised(spark.createDataFrame(rows, "doc_id long, text string, source string"), "null-ids")
    stay = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_dedup(spark, docs, sf).collect()]
    assert sorted(stay, key=repr) == sorted([(None, fox), (None, sea), (4, rows[3][1]), (7, "")], key=repr)


def test_near_dedup_tells_rows_apart_by_the_place_of_nulls(spark, sf):
    """One id, the same words in different columns; and columns of maps, whose order is none."""
    words = "some unlike words here"
    rows = [(5, None, words, {"a": 1, "b": None}), (5, words, None, {"a": 1, "b": None}), (6, "text of six here", "x", None),
            (6, "text of six here", "x", None), (7, "the seventh has own words", None, {}), (8, None, None, {"b": 2})]
    docs = materialised(spark.createDataFrame(rows, "doc_id long, text string, source string, extra map<string, int>"), "null-places")
    stay = [(r["doc_id"], r["text"], r["source"], r["extra"]) for r in corpus_pipeline.near_dedup(spark, docs, sf).collect()]
    # Rows 5 (its null text) and 8 have no words and are one group; all others are alone.
    assert sorted(stay, key=repr) == sorted([rows[0], rows[1], rows[2], rows[4]], key=repr)


def test_run_is_all_stages(spark, sf):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(out.columns)
    assert out.filter(F.size("ids") != F.col("n_tokens")).count() == 0
