"""The maximum-entropy language model: plain counts, plain loops, sums to one, gradients."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmine.llm import maxent
from sparkmine.llm.common import crc_bucket


def plain_tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    return [w.encode() for w in words] + [maxent.END]


@pytest.mark.parametrize("chunk", [1 << 20, 3])
def test_tokens(monkeypatch, chunk):
    monkeypatch.setattr(maxent, "CHUNK", chunk)
    for text in (None, "", " \t ", "The CAT\x0bsat  \x1con É mat\n", "a" * 50, " x y "):
        found = [w for part in maxent.tokens(text.encode() if text is not None else None) for w in part]
        assert found == plain_tokens(text)


def small_model(monkeypatch, words=("a", "b", "c", "dd", "ee", "ff", "xy", "zy"), softmax=6, members=4):
    monkeypatch.setattr(maxent, "SOFTMAX_WORDS", softmax)
    monkeypatch.setattr(maxent, "CLASS_WORDS", members)
    monkeypatch.setattr(maxent, "CLASS_ROWS", 64)
    monkeypatch.setattr(maxent, "WORD_ROWS", 64)
    names = [maxent.END, *(w.encode() for w in words)]
    counts = np.arange(len(names) + 2, 2, -1)
    tokens, distinct = np.zeros(maxent.RARE_CLASSES, dtype=np.int64), np.zeros(maxent.RARE_CLASSES, dtype=np.int64)
    for w, n in list(zip(names, counts))[softmax:]:
        tokens[maxent.rare_class(w)] += n
        distinct[maxent.rare_class(w)] += 1
    vocab = maxent.Vocabulary(names, counts, int(counts.sum()), len(names), tokens, distinct)
    weights = maxent.Weights.new(vocab)
    rng = np.random.default_rng(1)
    weights.classes[:] = rng.normal(size=weights.classes.shape)
    weights.members[:] = rng.normal(size=weights.members.shape)
    return maxent.Model(vocab, weights)


def plain_log(model, past, symbol):
    """log10 P of one symbol by plain loops over classes and members."""
    own, member = (int(x[0]) for x in model.targets(np.array([symbol])))
    rows, inner = maxent.rows_of(np.array([past]), np.array([own]))
    logits = [float(model.class_bias[c]) + sum(float(model.weights.classes[r, c]) for r in rows[0]) for c in range(model.vocab.classes)]
    p = math.exp(logits[own]) / sum(map(math.exp, logits))
    if member >= 0:
        size = maxent.CLASS_WORDS
        logits = [float(model.member_bias[own, m]) + sum(float(model.weights.members[r, m]) for r in inner[0]) for m in range(size)]
        p *= math.exp(logits[member]) / sum(math.exp(x) for x in logits)
    return math.log10(p)


def test_softmax_by_plain_loops_sums_to_one(monkeypatch):
    model = small_model(monkeypatch)
    past = [1, 3, model.start]
    every = [*range(6), *(maxent.SOFTMAX_WORDS + g for g in range(maxent.RARE_CLASSES))]
    found = model.log10(np.array([past] * len(every)), np.array(every))
    assert np.allclose(found, [plain_log(model, past, s) for s in every], atol=1e-5)
    assert abs((10**found).sum() - 1) < 1e-5  # two classes of four with two places empty, and the rare ones


def test_gradient_by_differences(monkeypatch):
    model = small_model(monkeypatch)
    monkeypatch.setattr(maxent, "STEP", 1e-3)
    history, symbols = np.array([[1, 2, 3], [0, 5, 1], [1, 2, 3], [maxent.SOFTMAX_WORDS + 3, 0, 0]]), np.array([2, 4, 0, maxent.SOFTMAX_WORDS + 1])
    before = model.log10(history, symbols).sum()
    old = [x.copy() for x in model.weights]
    model.update(history, symbols)
    assert model.log10(history, symbols).sum() > before
    for part in (0, 1):
        touched = np.flatnonzero(model.weights[part + 2] != old[part + 2])
        step = (old[part] - model.weights[part])[touched] * np.sqrt(model.weights[part + 2][touched])[:, None] / 1e-3
        table = model.weights[part]
        new = table.copy()
        table[:] = old[part]
        other = model.weights[1 - part].copy()
        model.weights[1 - part][:] = old[1 - part]
        for i, r in enumerate(touched[:6]):
            c = int(np.argmax(np.abs(step[i])))
            table[r, c] = old[part][r, c] + 0.01
            up = model.log10(history, symbols).sum()
            table[r, c] = old[part][r, c] - 0.01
            down = model.log10(history, symbols).sum()
            table[r, c] = old[part][r, c]
            assert abs((down - up) / 0.02 * math.log(10) - step[i, c]) < 0.02 * max(1, abs(step[i, c]))
        table[:] = new
        model.weights[1 - part][:] = other


def test_step_sums_repeated_rows():
    rng = np.random.default_rng(4)
    rows, gradient = rng.integers(0, 9, size=(400, 3)), rng.normal(size=(400, 5)).astype(np.float32)
    table, steps = np.zeros((9, 5), dtype=np.float32), np.full(9, 1e-6, dtype=np.float32)
    maxent._step(table, steps, rows, gradient)
    for r in range(9):
        total = sum(gradient[i] for i in range(400) for j in range(3) if rows[i, j] == r)
        assert np.allclose(table[r], -maxent.STEP * total / math.sqrt(1e-6 + (total**2).sum()), atol=1e-4)


def plain_base(train, texts):
    """(n_tokens, n_known, N, base) of each text."""
    counts = Counter(w for t in train for w in plain_tokens(t))
    n, v = sum(counts.values()), len(counts)
    return [(len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
            for ws in map(plain_tokens, texts)]


@pytest.mark.parametrize("table_words", [131_072, 40])
def test_base_and_counts(spark, documents, monkeypatch, table_words):
    """With a small table most words meet their counts in the join."""
    monkeypatch.setattr(maxent, "TABLE_WORDS", table_words)
    monkeypatch.setattr(maxent, "SOFTMAX_WORDS", min(maxent.SOFTMAX_WORDS, table_words))
    monkeypatch.setattr(maxent, "COUNTED", 500)
    docs = documents.filter("doc_id < 120").select("doc_id", "text")
    train = docs.filter("doc_id % 3 <> 0")
    rows = docs.orderBy("doc_id").collect()
    want = plain_base([r["text"] for r in rows if r["doc_id"] % 3], [r["text"] for r in rows])
    trained = maxent.train(train, rounds=2)
    found = maxent.score(docs, trained).orderBy("doc_id").collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"]) for r in found] == [w[:3] for w in want]
    assert np.allclose([r["base_score"] for r in found], [w[3] for w in want], rtol=1e-9)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)
    # The rare classes' sums are those of plain counts.
    counts = Counter(w for r in rows if r["doc_id"] % 3 for w in plain_tokens(r["text"]))
    rare = [0] * maxent.RARE_CLASSES
    for w, n in counts.items():
        rare[maxent.rare_class(w)] += n if w not in trained.vocab.words[:maxent.SOFTMAX_WORDS] else 0
    assert trained.vocab.rare_tokens.tolist() == rare
    assert len(trained.vocab.words) <= table_words and len(trained.vocab.words) >= min(len(counts), 0.5 * table_words)
    assert dict(zip(trained.vocab.words, trained.vocab.counts)).items() <= counts.items()


def test_scores_by_plain_loops(spark, documents, monkeypatch):
    """Whole texts through Spark against one token at a time."""
    monkeypatch.setattr(maxent, "PIECE", 200)
    monkeypatch.setattr(maxent, "CHUNK", 64)
    docs = documents.filter("doc_id < 60").select("doc_id", "text")
    trained = maxent.train(docs.filter("doc_id % 2 = 1"), rounds=1)
    model, vocab = maxent.Model(trained.vocab, trained.weights), trained.vocab
    counts = Counter(w for r in docs.filter("doc_id % 2 = 1").collect() for w in plain_tokens(r["text"]))
    short = docs.filter(F.length("text") < 400)
    for r in maxent.score(short, trained, keep=("doc_id", "text")).collect():
        past, total = [model.start] * 3, 0.0
        for w in plain_tokens(r["text"]):
            _, symbol = model.symbols([w])
            total += plain_log(model, past, int(symbol[0]))
            if symbol[0] >= maxent.SOFTMAX_WORDS:
                g = int(symbol[0]) - maxent.SOFTMAX_WORDS
                total += math.log10((counts[w] + 1) / (vocab.rare_tokens[g] + vocab.rare_words[g] + 1))
            past = [int(symbol[0]), past[0], past[1]]
        assert math.isclose(total, r["score"], rel_tol=1e-4)


def test_held_out_texts_are_likelier_than_by_words_alone(spark, documents):
    held = crc_bucket(F.col("doc_id"), 7) == 2
    trained = maxent.train(documents.filter(~held))
    r = maxent.score(documents.filter(held), trained).agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    assert r["s"] / r["n"] > r["b"] / r["n"] + 0.2


def test_odd_documents(spark, odd_documents):
    trained = maxent.train(odd_documents)
    found = maxent.score(odd_documents, trained, keep=("doc_id", "score", "size")).collect()
    assert len(found) == odd_documents.count()
    texts = [r["text"] for r in odd_documents.collect()]
    assert sorted(r["n_tokens"] for r in found) == sorted(len(plain_tokens(t)) for t in texts)
    none = maxent.train(odd_documents.limit(0))
    rows = maxent.score(odd_documents, none).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 and math.isfinite(r["score"]) for r in rows)
    assert maxent.score(odd_documents.limit(0), trained).count() == 0


def test_rare_classes_of_many_words():
    words = [b"a", b"xy", b"\x00", b"x\x00", "É".encode(), maxent.END, b"abc" * 9]
    assert maxent.rare_classes(words).tolist() == [maxent.rare_class(w) for w in words]
    assert maxent.rare_classes([]).tolist() == []


@pytest.mark.parametrize("places", [True, False])
@pytest.mark.parametrize("chunk", [1 << 20, 2])
@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1 << 16])
def test_pieces_by_plain_loops(monkeypatch, piece, chunk, places):
    """Texts of any length, cut anywhere: no history reaches into the text before, and
    training looks up no word but those of the softmax."""
    monkeypatch.setattr(maxent, "PIECE", piece)
    monkeypatch.setattr(maxent, "CHUNK", chunk)
    model = small_model(monkeypatch)
    model = maxent.Model(model.vocab, model.weights, places)
    assert bool(model.others) == places
    texts = [b"a b dd unknown c xy", None, b"c", b"zz a", b"", b"a a a b new ff zy a b c"]
    found, unknown = [], {}
    for text, place, symbol, history, outside in maxent.pieces(model, iter(texts)):
        found += zip(text.tolist(), place.tolist() if places else [None] * len(place), symbol.tolist(), map(tuple, history.tolist()))
        for i, words in outside:
            unknown.setdefault(i, []).extend(words)
    want = []
    for i, text in enumerate(texts):
        past = [model.start] * 3
        for word in plain_tokens((text or b"").decode()):
            at = model.vocab.words.index(word) if word in model.vocab.words else -1
            symbol = at if 0 <= at < maxent.SOFTMAX_WORDS else maxent.SOFTMAX_WORDS + maxent.rare_class(word)
            want.append((i, at if places else None, symbol, tuple(past)))
            past = [symbol, *past[:2]]
    assert found == want
    rest = {i: [w for w in plain_tokens((t or b"").decode()) if w not in model.vocab.words] for i, t in enumerate(texts)}
    assert {i: w for i, w in unknown.items() if w} == ({i: w for i, w in rest.items() if w} if places else {})


@pytest.mark.parametrize("near", [2, 512])
def test_step_in_blocks_of_rows(monkeypatch, near):
    """Rows of one entry, of some and of more than SHORT, over several blocks."""
    monkeypatch.setattr(maxent, "NEAR", near)
    rng = np.random.default_rng(6)
    rows = np.concatenate((np.zeros(maxent.SHORT * 2), np.ones(maxent.SHORT), np.full(maxent.SHORT + 1, 2), np.arange(3, 30), np.arange(20, 30)))
    rows = rng.permutation(rows.astype(np.int64))[:, None]
    gradient = rng.normal(size=(len(rows), 5)).astype(np.float32)
    table, steps = np.zeros((30, 5), dtype=np.float32), np.full(30, 1e-6, dtype=np.float32)
    maxent._step(table, steps, rows, gradient)
    for r in range(30):
        total = gradient[rows[:, 0] == r].astype(float).sum(axis=0)
        assert np.allclose(table[r], -maxent.STEP * total / math.sqrt(1e-6 + (total**2).sum()), atol=1e-4)
