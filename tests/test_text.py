"""Word splitting and n-grams."""

from pyspark.sql import functions as F

from sparkmine.functions import text as T


def test_unicode_words_keep_empties(spark):
    df = spark.createDataFrame([("the é_cole, x ",)], "t string")
    assert df.select(T.words("t").alias("w")).first().w == ["the", "é_cole", "", "x", ""]


def test_word_counts(spark):
    df = spark.createDataFrame([("a bb a",), ("",)], "t string")
    got = {r.word: r["count"] for r in T.word_count(df, "t").collect()}
    assert got == {"a": 2, "bb": 1, "": 1}
    short = {r.word for r in T.word_count(df, "t", max_len=1).collect()}
    assert short == {"a", ""}


def test_ngrams_stay_in_sentences(spark):
    df = spark.createDataFrame([("g", "Why does it cost more? It does.")], "g string, t string")
    grams = df.select(T.sentence_ngrams("t", 2).alias("n")).first().n
    assert "more it" not in grams and "why does" in grams
    top = T.top_ngrams(df, "g", T.sentence_ngrams("t", 2), 1).collect()
    assert len(top) == 1 and top[0].estfrequency == 1.0


def test_short_token_arrays_give_no_grams(spark):
    df = spark.createDataFrame([(["a"],)], "t array<string>")
    assert df.select(T.ngrams_of(F.col("t"), 2).alias("g")).first().g == []


def test_sentences_of_hand_texts(spark):
    """The text is lower-cased first, as the reference does it, so a full stop ends no
    sentence (a lower-case word follows); ``!`` and ``?`` do. Decimals stay whole, a line
    break is a blank, words lose their punctuation and keep accents."""
    texts = {
        "It costs 3.50 today. Why? Because!": [["it", "costs", "3.50", "today", "why"], ["because"]],
        "L'été arrive! Enfin": None,
        "one line\nand the next. End": [["one", "line", "and", "the", "next", "end"]],
        "": [],
    }
    for text, expected in texts.items():
        got = spark.createDataFrame([(text,)], "t string").select(T.sentences("t").alias("s")).first().s
        if expected is not None:
            assert got == expected, text
        flat = [w for s in got for w in s]
        assert all(w.lower() in text.lower() for w in flat)
        assert "".join(c for w in flat for c in w if c.isalnum()) == "".join(c for c in text.lower() if c.isalnum()), text


def test_plain_sentences(spark):
    df = spark.createDataFrame([("One two. Three\nfour!  FIVE six?",)], "t string")
    got = [s for s in df.select(T.plain_sentences("t").alias("s")).first().s if s]
    assert got == [["one", "two"], ["three"], ["four"], ["five", "six"]]
