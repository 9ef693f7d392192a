"""A training-corpus pipeline over ``documents``: low-quality texts go, one document of each
group of near duplicates stays, secrets are masked, sources are mixed to target weights,
and what is left is encoded.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's docs. All but the
last return the columns of their docs. Every stage works on all rows that it gets, and
``sf_dir`` gives it nothing but labels.

Defined cases: rows with null or empty text are scored, grouped and encoded like any other
(``quality``, ``simhash`` and ``bpe`` say how); repeated rows are one group; empty docs give
empty results. Columns of docs beyond doc_id, text, source and n_chars are passed on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmine.llm import bpe, mixing, quality, queries, secret_scan, simhash
from sparkmine.llm.common import materialised, table

ORACLE_SQL = None  # XXH64, the learned models and the vocabulary are beyond SQL


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, trained on the labels, doesn't reject."""
    weights = queries.quality_weights(spark, docs, sf_dir)
    return docs.filter(quality.score(F.col("text"), weights) >= 0.3)


def _row_hash(docs: DataFrame) -> Column:
    """A hash of whole rows in which null differs from every value, and so does its place.
    Maps (which have no hash and no order) go in as their ordered entries."""
    parts = []
    for f in docs.schema.fields:
        c = F.col(f"`{f.name}`")
        entries = F.transform(F.map_entries(c), lambda e: F.to_json(F.struct(e))) if isinstance(f.dataType, T.MapType) else None
        parts += [c.isNull(), c if entries is None else F.array_sort(entries)]
    return F.xxhash64(*parts)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id; of rows with that id
    the one with the smallest hash of all its columns, and that once. Rows without an id
    are grouped like any other, and stay only where their group has no id at all."""
    row_hash = _row_hash(docs)
    found = simhash.near_duplicates(
        docs.select("doc_id", "text", row_hash.alias("row")), keep=("row",), shingle=3, max_distance=2, root="group")
    first = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("f"))
    stay = materialised(first.select(F.col("f.row").alias("__row")).distinct(), "stay")
    # Hashes of whole rows: equal rows meet, and one of them stays.
    rows = docs.withColumn("__row", row_hash).join(stay, "__row", "left_semi")
    return rows.dropDuplicates(["__row"]).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts masked and n_chars to match."""
    forest = secret_scan.forest_for(docs)
    rows = docs.select(F.struct(*docs.columns).alias("doc"), "text", "source")
    clean = secret_scan.scan(rows, forest, path="source", redact=True)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)}
    return clean.select(*[new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target takes it, from not at all to
    three times. Documents are taken whole."""
    named = docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", "source", "text")
    mixed = mixing.mix_sources(mixing.sized(named).drop("text"), whole_documents=True)
    # An empty document has no words to count, and stays once.
    times = F.when(F.col("size") > 0, F.col("taken") / F.greatest(F.col("size"), F.lit(1))).otherwise(F.lit(1)).cast("int")
    return mixed.withColumn("times", times).filter("times > 0").select(
        "doc", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy")).select("doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids and the digests of the ids and of the decoded bytes."""
    ranks, pattern = queries.vocabulary()
    give = ("n_tokens", "ids", "ids_sha256", "decoded_sha256")
    encoded = bpe.encode(docs.select("doc_id", "source", "text"), ranks, pattern, give=give)
    return encoded.select("doc_id", "source", *give)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_filter),
    ("near_dedup", near_dedup),
    ("secrets", mask_secrets),
    ("mixing", mix),
    ("encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage's rows go through the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialised(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
