"""The classifiers: held-out accuracy, defined cases, whole texts, and gradients."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmine.llm import langid, quality
from sparkmine.llm.common import crc_bucket


def test_crc_bucket(spark):
    rows = spark.createDataFrame([(0,), (17,), (-5,), (None,)], "i long").select("i", crc_bucket(F.col("i"), 5).alias("b")).collect()
    assert [r["b"] for r in rows] == [zlib.crc32(str(r["i"]).encode()) % 5 if r["i"] is not None else -1 for r in rows]


@pytest.fixture(scope="module")
def weights(spark, sf, documents):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return quality.train(documents, labels.filter(crc_bucket(F.col("doc_id"), 5) != 0))


def test_quality_on_held_out_rows(spark, sf, documents, weights):
    scored = quality.classify(documents, weights).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = scored.filter(crc_bucket(F.col("doc_id"), 5) == 0).select("quality", "score", "predicted").collect()
    good, bad = [r for r in rows if r["quality"] == 1], [r for r in rows if r["quality"] == 0]
    assert np.mean([r["predicted"] for r in good]) > 0.98 and np.mean([r["predicted"] for r in bad]) < 0.3
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_quality_of_odd_rows(spark, odd_documents, weights):
    rows = quality.classify(odd_documents, weights).collect()
    assert len(rows) == odd_documents.count()
    bias = 1 / (1 + np.exp(-weights[0]))
    assert all(abs(r["score"] - bias) < 1e-9 for r in rows if r["text"] is None or not r["text"].strip())
    assert quality.classify(odd_documents.limit(0), weights).count() == 0
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 0), (3, 7), (99, 0)], "doc_id long, quality int")
    assert quality.train(odd_documents, labels).any()  # one usable row is enough
    none = quality.train(odd_documents, labels.limit(0))
    assert not none.any() and {r["score"] for r in quality.classify(odd_documents, none).collect()} == {0.5}


def plain_features(text: bytes, bits=18):
    """n-grams counted in dictionaries, with the hashes of single words as given."""
    w, s = quality.word_hashes(np.frombuffer(text, dtype=np.uint8))
    m, mask = (1 << 64) - 1, (1 << bits) - 1

    def mix(h):
        h = ((h ^ h >> 33) * 0xFF51AFD7ED558CCD) & m
        return h ^ h >> 29

    w, s = [0, 0, *map(int, w)], [0, 0, *map(int, s)]
    words, shapes = {}, {}
    for i in range(2, len(w)):
        for g in (w[i], mix((w[i] * 3 + w[i - 1]) & m)):
            words[g & mask] = words.get(g & mask, 0) + 1
        for g in ((s[i] + 1) & m, mix((s[i] * 5 + s[i - 1]) & m), mix((s[i] * 7 + s[i - 1] * 3 + s[i - 2]) & m),
                  mix(11 if w[i] == w[i - 1] else 13)):
            shapes[g & mask] = shapes.get(g & mask, 0) + 1
    return words, shapes


def test_features_count_the_whole_text(monkeypatch):
    text = ("Some words SHOUT!! repeat repeat 12 é " * 40).encode()
    places, values = quality.features(text)
    words, shapes = plain_features(text)
    assert dict(zip(places[1:1 + len(words)].tolist(), values[1:1 + len(words)])) == pytest.approx(
        {k: np.log1p(v) / np.sqrt(sum(np.log1p(x) ** 2 for x in words.values())) for k, v in words.items()})
    assert set(places[1 + len(words):].tolist()) == set(shapes)
    monkeypatch.setattr(quality, "CHUNK", 50)
    again = quality.features(text)
    assert (again[0] == places).all() and np.allclose(again[1], values)


def test_one_shape_for_words_of_one_form():
    _, s = quality.word_hashes(np.frombuffer(b"THE!! OF!! the On in a1", dtype=np.uint8))
    assert s[0] == s[1] and s[2] == s[4] and len(set(s.tolist())) == 4


def test_languages_of_held_out_rows(documents):
    net = langid.train(documents.filter(crc_bucket(F.col("doc_id"), 4) != 2))
    rows = langid.identify(documents.filter(crc_bucket(F.col("doc_id"), 4) == 2), net).select("lang", "lang_pred", "score").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in net.langs for r in rows)


def test_language_of_odd_rows(spark, odd_documents):
    net = langid.train(odd_documents)
    rows = {r["doc_id"]: r for r in langid.identify(odd_documents, net).collect()}
    assert {i for i, r in rows.items() if r["lang_pred"] == "und"} == {2, 3, 4} and rows[3]["score"] == 0
    assert langid.identify(odd_documents.limit(0), net).count() == 0
    nothing = langid.train(odd_documents.filter("lang is null"))
    assert nothing is None and {r["lang_pred"] for r in langid.identify(odd_documents, nothing).collect()} == {"und"}


def test_a_text_is_read_to_its_end():
    net = langid.new_network(["a", "b"])
    text = b"x y z " * 400 + b"w" * 5000
    got = langid.predict(net, [text, b"", None, b"abc", text * 30])
    p, cuts = langid.window_probabilities(net, langid.cut(text)), langid.cut(text)
    letters = langid._LETTER[cuts].sum(axis=1)
    mean = (p * letters[:, None]).sum(axis=0) / letters.sum()
    assert got[0][0] == net.langs[int(mean.argmax())] and got[0][1] == pytest.approx(float(mean.max()), rel=1e-5)
    assert got[1] == got[2] == ("und", 0.0) and len(got) == 5


def test_gradients_are_those_of_the_loss():
    net = langid.new_network(["a", "b", "c"])
    for name in ("bytes_", "filters", "bias", "dense", "dense_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    windows = np.random.default_rng(3).integers(0, 256, (5, 20)).astype(np.uint8)
    wanted = np.eye(3)[[0, 1, 2, 1, 0]]

    def loss():
        return -(wanted * np.log(langid._forward(net, windows)[2])).sum() / 5

    for p, g in zip(net.parameters(), langid._gradients(net, windows, wanted)):
        for at in [tuple(np.unravel_index(i, p.shape)) for i in np.argsort(-np.abs(g), axis=None)[:4]]:
            old, step = p[at], 1e-6
            p[at] = old + step
            up = loss()
            p[at] = old - step
            down = loss()
            p[at] = old
            assert (up - down) / (2 * step) == pytest.approx(g[at], rel=1e-3, abs=1e-8)


def test_an_id_with_two_languages_teaches_each_its_own_text(spark):
    rows = [(1, "the cat sat", "en"), (1, "le chat est assis", "fr"), (2, "the dog ran", "en"), (2, "the dog ran", "en"),
            (3, None, "en"), (4, "12 34", "en"), (None, "no id", "en"), (5, "no language", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.training_windows(df, doc_id="doc_id", text="text", lang="lang", per_lang=9, max_train=9)
    assert {(r.id, r.lang, bytes(r.piece).decode()) for r in got.itertuples()} == {
        (1, "en", "the cat sat"), (1, "fr", "le chat est assis"), (2, "en", "the dog ran")}
    assert len(got) == 6


def test_rows_of_one_id_are_one_row_of_the_sample(spark):
    df = spark.range(3000).select(F.lit(8).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("en").alias("lang"))
    got = langid.training_windows(df, doc_id="doc_id", text="text", lang="lang", per_lang=5, max_train=9)
    assert len(got) == 2 and got["id"].tolist() == [8, 8] and got["piece"].nunique() == 1
    labels = spark.createDataFrame([(8, 1), (9, 0)], "doc_id long, quality int")
    more = df.drop("lang").union(spark.createDataFrame([(9, "other words")], "doc_id long, text string"))
    first = quality.train(more, labels, bits=10)
    assert (first == quality.train(more.repartition(7), labels, bits=10)).all()


def test_filters_are_those_of_plain_loops():
    """Each filter slides over the bytes' vectors, keeps its largest answer, and a softmax
    over the kept ones follows."""
    net = langid.new_network(["a", "b", "c"])
    net.bias += np.linspace(-0.2, 0.2, len(net.bias), dtype=np.float32)
    windows = np.random.default_rng(5).integers(0, 256, (3, 24)).astype(np.uint8)
    got = langid.window_probabilities(net, windows)
    for window, row in zip(windows, got):
        vectors = [net.bytes_[b] for b in window]
        hidden = []
        for f in range(net.filters.shape[1]):
            width = langid.WIDTHS[f // langid.FILTERS]
            weights = net.filters[:, f].reshape(max(langid.WIDTHS), langid.BYTE_DIMS)
            answers = [sum(float(weights[j, i]) * float(vectors[at + j][i]) for j in range(width) for i in range(langid.BYTE_DIMS))
                       for at in range(len(window) - max(langid.WIDTHS) + 1)]
            hidden.append(max(0.0, max(answers) + float(net.bias[f])))
        logits = [sum(h * float(net.dense[f, c]) for f, h in enumerate(hidden)) + float(net.dense_bias[c]) for c in range(3)]
        total = sum(np.exp(v) for v in logits)
        assert row == pytest.approx([np.exp(v) / total for v in logits], rel=1e-4)


def test_weights_are_those_of_a_plain_ftrl():
    """FTRL-proximal written out one coordinate at a time, with dictionaries."""
    rng = np.random.default_rng(9)
    rows = [(rng.choice(32, 5, replace=False), rng.random(5) + 0.1, int(rng.random() < 0.5)) for _ in range(60)]
    got = quality.ftrl(rows, 5, 3)
    z, n = {}, {}

    def weight(i):
        zi, ni = z.get(i, 0.0), n.get(i, 0.0)
        if abs(zi) <= quality.L1:
            return 0.0
        return (np.sign(zi) * quality.L1 - zi) / ((quality.BETA + np.sqrt(ni)) / quality.ALPHA + quality.L2)

    for _ in range(3):
        for places, values, y in rows:
            now = {int(i): weight(int(i)) for i in places}
            p = 1 / (1 + np.exp(-sum(now[int(i)] * v for i, v in zip(places, values))))
            for i, v in zip(places, values):
                i, g = int(i), (p - y) * v
                sigma = (np.sqrt(n.get(i, 0.0) + g * g) - np.sqrt(n.get(i, 0.0))) / quality.ALPHA
                z[i] = z.get(i, 0.0) + g - sigma * now[i]
                n[i] = n.get(i, 0.0) + g * g
    assert got == pytest.approx([weight(i) for i in range(32)], rel=1e-9, abs=1e-12)
