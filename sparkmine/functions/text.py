"""Text functions: word splitting, word statistics, sentences and n-grams.

Built-in expressions (``split``, ``explode``, ``sentences``, ``transform``), so the work
stays in the JVM; counts are partial aggregates. Only estimated n-grams are counted in
Python, in bounded sketches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.functions.sketch import heavy_hitters

# Fixed values that must equal the reference's behaviour:
# Python's re.split('\W', line) is Unicode-aware and keeps '_' inside words; the Java
# form with the same word boundary is the UNICODE_CHARACTER_CLASS flag (?U) on \W.
WORD_SPLIT = r"(?U)\W"
# A word "starts with a letter" when its first character is an ASCII letter.
ASCII_LETTER_START = r"^[a-zA-Z]"
# Letters-only tokens of the simple n-gram form.
SIMPLE_TOKEN_SPLIT = r"[^a-z]+"


def words(text: Column | str) -> Column:
    """All words of a text, empty words included (as Python's ``re.split`` gives them)."""
    return F.split(F.col(text) if isinstance(text, str) else text, WORD_SPLIT, -1)


def word_column(df: DataFrame, text: str, name: str = "word") -> DataFrame:
    return df.select(F.explode(words(text)).alias(name))


def word_count(df: DataFrame, text: str, max_len: int | None = None) -> DataFrame:
    """``(word, count)``; with ``max_len`` only words of at most that length (empty kept)."""
    w = word_column(df, text)
    if max_len is not None:
        w = w.filter(F.length("word") <= max_len)
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def avg_word_length(df: DataFrame, text: str) -> DataFrame:
    """Average length of words per first character, for words starting with an ASCII letter."""
    w = word_column(df, text).filter(F.col("word").rlike(ASCII_LETTER_START))
    return w.groupBy(F.substring("word", 1, 1).alias("letter")).agg(F.avg(F.length("word")).alias("avg_length"))


def kv_lines(df: DataFrame, key: str, value: str, sep: str = ": ") -> DataFrame:
    """``key: value`` text lines (the reference's formatted output)."""
    return df.select(F.concat_ws(sep, F.col(key).cast("string"), F.col(value).cast("string")).alias("value"))


def sentences(text: Column | str) -> Column:
    """``SENTENCES(LOWER(text))``: array of sentences, each an array of words."""
    t = F.col(text) if isinstance(text, str) else text
    return F.sentences(F.lower(t))


def ngrams_of(tokens: Column, n: int, sep: str = " ") -> Column:
    """All contiguous n-grams of a token array, each joined by ``sep``; empty if too short."""
    # Each gram is built from n direct element lookups (no intermediate slice array).
    grams = F.transform(F.sequence(F.lit(0), F.size(tokens) - n),
                        lambda i: F.concat_ws(sep, *[F.element_at(tokens, i + (j + 1)) for j in range(n)]))
    return F.when(F.size(tokens) >= n, grams).otherwise(F.array().cast("array<string>"))


def simple_tokens(text: Column | str) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(t), SIMPLE_TOKEN_SPLIT, -1), lambda w: w != "")


def top_ngrams(df: DataFrame, group: str, grams: Column, k: int) -> DataFrame:
    """Top ``k`` n-grams per group by frequency, ties by the n-gram text:
    ``(group, ngram, estfrequency double)``. Exact counts (Hive's NGRAMS estimates)."""
    g = df.select(group, F.explode(grams).alias("ngram"))
    counts = g.groupBy(group, "ngram").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(group).orderBy(F.col("_n").desc(), F.col("ngram").asc())
    return (counts.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= k)
            .select(group, "ngram", F.col("_n").cast("double").alias("estfrequency")))


# Between the words of an n-gram while it is counted; no word holds it.
_BETWEEN = "\x1f"


def ngrams_estimated(df: DataFrame, group: str, sentences: Column, n: int, k: int, precision: int = 1024) -> DataFrame:
    """Hive's ``NGRAMS(sentences, n, k, precision)`` per group: the top ``k`` n-grams that stay
    inside a sentence, ``(group, ngram array<string>, estfrequency double, error double)``,
    ties by the words. ``sentences``: array of arrays of words.

    Frequencies come from bounded sketches of ``precision * k`` counters a group (see
    ``sketch.py``): the true one is at least ``estfrequency`` and at most ``error`` more, and
    ``error`` is 0 where a group has no more distinct n-grams than counters."""
    grams = F.flatten(F.transform(sentences, lambda s: ngrams_of(s, n, _BETWEEN)))
    found = heavy_hitters(df, group, grams, precision * k)
    best = Window.partitionBy(group).orderBy(F.col("n").desc(), F.col("item").asc())
    top = found.withColumn("_rk", F.row_number().over(best)).filter(F.col("_rk") <= k)
    return top.select(group, F.split("item", _BETWEEN).alias("ngram"), F.col("n").cast("double").alias("estfrequency"),
                      F.col("lost").cast("double").alias("error"))


def sentence_ngrams(text: Column | str, n: int) -> Column:
    """n-grams that stay inside one sentence of ``SENTENCES(LOWER(text))``."""
    per_sentence = F.transform(sentences(text), lambda s: ngrams_of(s, n))
    return F.flatten(per_sentence)


# What ends a sentence, and what stands between words, in plain sentences.
PLAIN_SENTENCE_END = r"[.!?\n]+"


def plain_sentences(text: Column | str) -> Column:
    """Sentences by a plain rule that any engine can state: a sentence ends at ``.``, ``!``,
    ``?`` or a line break; words are runs of a-z of the lower-cased text. Array of
    sentences, each an array of words; without the language rules of ``sentences``."""
    t = F.col(text) if isinstance(text, str) else text
    parts = F.split(F.lower(t), PLAIN_SENTENCE_END, -1)
    return F.transform(parts, lambda s: F.filter(F.split(s, SIMPLE_TOKEN_SPLIT, -1), lambda w: w != ""))
