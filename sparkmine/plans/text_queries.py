"""Registered text queries: word statistics over documents, sentences and n-grams over
rating messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmine.functions import text as T
from sparkmine.plans import views as V
from sparkmine.plans.catalog import register
from sparkmine.plans.oracle_views import with_views as W

TOP_K = 5
SHORT_WORD = 5

# DuckDB form of the Unicode word boundary: letters, numbers, marks and '_' are word characters.
_WORDS_SQL = r"select unnest(string_split_regex(text, '[^\p{L}\p{N}\p{M}_]')) as word from documents"


@register("word_count", f"select word, count(*) as count from ({_WORDS_SQL}) group by word")
def word_count(spark, d):
    return T.word_count(V.table(spark, d, "documents"), "text")


@register("word_count_short", f"""select word, count(*) as count from ({_WORDS_SQL}) where length(word) <= {SHORT_WORD}
group by word""")
def word_count_short(spark, d):
    return T.word_count(V.table(spark, d, "documents"), "text", max_len=SHORT_WORD)


@register("avg_word_length", f"""select substring(word, 1, 1) as letter, avg(length(word)) as avg_length
from ({_WORDS_SQL}) where regexp_matches(word, '^[a-zA-Z]') group by letter""")
def avg_word_length(spark, d):
    return T.avg_word_length(V.table(spark, d, "documents"), "text")


@register("sentences_tokens")
def sentences_tokens(spark, d):
    """``SENTENCES(LOWER(message))`` exploded to (post_id, sentence, position, token)."""
    r = V.ratings(spark, d)
    s = r.select("post_id", F.posexplode(T.sentences("message")).alias("sentence", "_toks"))
    return s.select("post_id", "sentence", F.posexplode("_toks").alias("position", "token"))


@register("top_bigrams")
def top_bigrams(spark, d):
    """``EXPLODE(NGRAMS(SENTENCES(LOWER(message)), 2, 5))`` per product, exact counts."""
    r = V.ratings(spark, d)
    return T.top_ngrams(r, "prod_id", T.sentence_ngrams("message", 2), TOP_K)


@register("top_trigrams")
def top_trigrams(spark, d):
    r = V.ratings(spark, d)
    return T.top_ngrams(r, "prod_id", T.sentence_ngrams("message", 3), TOP_K)


_SIMPLE_TOKENS = """select prod_id, list_filter(string_split_regex(lower(message), '[^a-z]+'), lambda w: w <> '') as toks
            from ratings"""


def _simple_sql(n: int) -> str:
    return W(f"""select prod_id, ngram, cast(cnt as double) as estfrequency from (
  select *, row_number() over (partition by prod_id order by cnt desc, ngram) as rk from (
    select prod_id, ngram, count(*) as cnt from (
      select prod_id, unnest(list_transform(range(0, len(toks) - {n - 1}),
        lambda i: array_to_string(list_slice(toks, i + 1, i + {n}), ' '))) as ngram
      from ({_SIMPLE_TOKENS}))
    group by prod_id, ngram))
where rk <= {TOP_K}""", "ratings")


@register("top_bigrams_simple", _simple_sql(2))
def top_bigrams_simple(spark, d):
    r = V.ratings(spark, d).select("prod_id", T.simple_tokens("message").alias("toks"))
    return T.top_ngrams(r, "prod_id", T.ngrams_of(F.col("toks"), 2), TOP_K)


@register("top_trigrams_simple", _simple_sql(3))
def top_trigrams_simple(spark, d):
    r = V.ratings(spark, d).select("prod_id", T.simple_tokens("message").alias("toks"))
    return T.top_ngrams(r, "prod_id", T.ngrams_of(F.col("toks"), 3), TOP_K)


_SENTENCE_TOKENS = """select prod_id, list_filter(string_split_regex(s, '[^a-z]+'), lambda w: w <> '') as toks from (
  select prod_id, unnest(string_split_regex(lower(message), '[.!?\n]+')) as s from ratings)"""


@register("top_bigrams_sentences", _simple_sql(2).replace(_SIMPLE_TOKENS, _SENTENCE_TOKENS))
def top_bigrams_sentences(spark, d):
    """Bigrams that stay inside one sentence, by the plain sentence rule."""
    grams = F.flatten(F.transform(T.plain_sentences("message"), lambda s: T.ngrams_of(s, 2)))
    return T.top_ngrams(V.ratings(spark, d), "prod_id", grams, TOP_K)


@register("bigrams_estimated", "select *, 0.0::double as error from (" + _simple_sql(2).replace(_SIMPLE_TOKENS, _SENTENCE_TOKENS) + ")")
def bigrams_estimated(spark, d):
    """``NGRAMS(sentences, 2, 5)`` by sketches of 81,920 counters a product, which hold all
    bigrams of one here, so that nothing is lost."""
    found = T.ngrams_estimated(V.ratings(spark, d), "prod_id", T.plain_sentences("message"), 2, TOP_K, precision=1 << 14)
    return found.select("prod_id", F.array_join("ngram", " ").alias("ngram"), "estfrequency", "error")
