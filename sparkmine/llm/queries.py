"""The registered queries of this subpackage and, where SQL can express one, its DuckDB
text. Each applies its operator, with production parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.llm import (
    bpe, chat, clusters, langid, maxent, mixing, negatives, permutation, quality, secret_scan, simhash, vafile, warc)
from sparkmine.llm.common import crc_bucket, materialised, table
from sparkmine.session import checkpoint_dir, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = mixing.sized(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "quality")
    mixed = mixing.mix_sources(materialised(docs, "sizes"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


@query
def op2_vafile_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5, scale=256)


ORACLE["op2_vafile_top_k"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from p)
select query_id, rank, vec_id, score from r where rank <= 5"""


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = secret_scan.scan(docs, secret_scan.forest_for(docs), path="source")
    f = found.select("doc_id", F.posexplode_outer("findings").alias("finding", "f")).filter(F.col("f").isNotNull())
    return f.select("doc_id", "finding", "f.start", F.length("f.value").alias("length"),
                    F.sha2("f.value", 256).alias("value_sha256"), "f.score", "f.is_secret")


def vocabulary(path: str | None = None) -> tuple[bpe.Ranks, str]:
    """(ranks, pattern) of a public tokenizer; ``path``: its rank file."""
    import public_tokenizers

    return bpe.Ranks.read(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = vocabulary()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, ranks, pattern, give=("n_tokens", "ids_sha256", "decoded_sha256"))
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=2)


@query
def op6_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("</s>[INST] ok [/INST]").alias("text")
    turn = F.col("id").alias("turn")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), turn,
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said)
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.conversation_digests(chat.chat_examples(conversations))


_MARK = r"([<\[])(\\*)(/?(?:s>|INST[\]:]))"
ORACLE["op6_chat_prefix_targets"] = rf"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
f as (
  select *, length(regexp_replace(text, '{_MARK}', '\1\\\2\3', 'g')) + case role when 'assistant' then 6 when 'user' then 18
      else 19 + length(url_encode(role)) end as chars,
    row_number() over w as i, count(*) over (partition by conv_id) as n
  from c window w as (partition by conv_id order by turn, role, text)),
g as (select *, sum(chars) over (partition by conv_id order by i) as upto from f)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by i) filter (role = 'assistant'), '')) as loss_sha256,
  sum(upto) filter (role = 'assistant' or i = n)::bigint as formatted_chars
from g group by conv_id"""


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_bucket(F.col("doc_id"), 4) == 2
    net = langid.train(docs.filter(~held_out))
    found = langid.identify(docs.select("doc_id", "text"), net)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op8_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


def quality_weights(spark: SparkSession, docs: DataFrame, sf_dir: str):
    """Learned from the labels outside the held-out fifth of the ids."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return quality.train(docs, labels.filter(crc_bucket(F.col("doc_id"), 5) != 0))


@query
def op9_quality_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.classify(docs, quality_weights(spark, docs, sf_dir), threshold=0.3)
    return scored.select("doc_id", (crc_bucket(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


@query
def op10_warc_content_addressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    checkpoint_dir(spark)
    path = scratch_path(spark, "archive")
    warc.write_archive(table(spark, sf_dir, "pages"), path, min_bytes=0)
    return warc.read_archive(spark, path).select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))


ORACLE["op10_warc_content_addressed"] = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, octet_length(encode(html))::bigint as payload_bytes, sha1(html) as hex,
  max(page_id) over (partition by html) as owner from p)
select page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (((('0x' || substr(hex, (i // 8 * 10 + 1)::int, 10))::bigint >> (35 - i % 8 * 5)::int) & 31) + 1)::int, 1)), '') as payload_digest,
  case when page_id = owner then 'response' else 'revisit' end as record_type,
  case when page_id <> owner then owner end as refers_to
from d"""


@query
def op11_ns_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clusters.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, components=64, scale=256, salt="2:")
    return clusters.with_inertia(found).select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _clusters_sql(k: int, rounds: int) -> str:
    """The rounds one after another; a centroid is a list of its components as doubles, in
    which all integers here are exact."""
    steps = [f"""
v as materialized (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v,
    row_number() over (order by sha256('2:' || vec_id::varchar) nulls last, list_transform(embedding, lambda x: floor(256 * x::double))) as h
  from embeddings where embedding is not null and len(embedding) = 64
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c0 as materialized (select (h - 1)::int as c, v as m from v where h <= {k})"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} as materialized (select h, any_value(vec_id) as vec_id, any_value(v) as v, arg_min(c, d * 1000 + c) as c, min(d) as d from (
  select *, list_inner_product(v, v) - 2 * list_inner_product(v, m) + list_inner_product(m, m) as d from v, c{r}) group by h)""")
        if r < rounds:
            steps.append(f"""
s{r} as materialized (select c, i, floor(sum(x) / count(*)) as x from (
  select c, unnest(v) as x, generate_subscripts(v, 1) as i from a{r}) group by c, i),
c{r + 1} as materialized (select c, coalesce(n.m, c{r}.m) as m from c{r} left join (select c, list(x order by i) as m from s{r} group by c) n using (c))""")
    return f"""with {",".join(steps)},
t as (select c, sum(d)::bigint as own from a{rounds} group by c)
select vec_id, a.c as cluster, d::bigint as distance, own as cluster_inertia, (select sum(own) from t)::bigint as inertia,
  sha256(array_to_string(list_transform(m, lambda x: x::bigint), ',')) as centroid_sha256
from a{rounds} a join t using (c) join c{rounds} using (c)"""


ORACLE["op11_ns_clusters"] = _clusters_sql(40, 5)


@query
def op12_kronecker_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return negatives.hard_negatives(rows, F.col("id") % 100 == 0, positives=5, negatives=5, low=80, high=100, scale=256)


ORACLE["op12_kronecker_negatives"] = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where embedding is not null and label is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as materialized (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, list_inner_product(a.v, c.v)::bigint as score
  from v a join v c on a.vec_id <> c.vec_id where a.vec_id % 100 = 0),
p as (select *, row_number() over (partition by anchor_id order by score desc, vec_id) as place from s where same),
n as (
  select p.anchor_id, p.vec_id as positive_id, s.vec_id as negative_id, p.score as positive_score, s.score as negative_score,
    row_number() over (partition by p.anchor_id, p.vec_id order by s.score desc, s.vec_id)::int as rank
  from p join s on p.anchor_id = s.anchor_id and not s.same
    and 80 * p.score <= 100 * s.score and 100 * s.score <= 100 * p.score where p.place <= 5)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 5"""


@query
def op13_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_bucket(F.col("doc_id"), 7) == 2
    trained = maxent.train(docs.filter(~held_out))
    scored = maxent.score(docs, trained)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
