"""Language identification with a byte convolutional network, trained in numpy.

A text is cut into windows of WINDOW bytes. Each byte becomes a small vector; filters of
several widths run over them; every filter keeps its largest answer in the window, and a
softmax over these gives the window's languages. A text's probabilities are the mean of
its windows', weighed by their letters, over the whole text.

Training takes a bounded sample: about ``per_lang`` rows of each language, ``max_train`` in
all at most, by the smallest hash of their id, with two windows each at places given by the hash.
Rows that share id and language count as one, and the text with the smallest hash stands for
them. The sample fits on one machine and is trained there (Adam, cross-entropy).

Defined cases: a text that is null or has no letter is ``und`` with score 0; so is every
text if nothing was learned; rows with a null id or language are never trained on;
an id with several languages is a row of each, with that language's text; repeated rows are predicted alike; an empty table gives no rows; other columns are kept,
but for ``lang_pred`` and ``score``, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.common import materialised, with_lookup

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
BYTE_DIMS = 8
PER_LANG = 1500
MAX_TRAIN = 12_000
EPOCHS = 6
WINDOWS_AT_ONCE = 512

_LETTER = np.zeros(256, dtype=np.float32)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(128, 256)]] = 1


@dataclass
class Network:
    langs: list[str]
    bytes_: np.ndarray  # 256 x BYTE_DIMS
    filters: np.ndarray  # max width * BYTE_DIMS x filters; narrow filters end in zeros
    bias: np.ndarray
    dense: np.ndarray  # filters x langs
    dense_bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.bytes_, self.filters, self.bias, self.dense, self.dense_bias]


def new_network(langs: list[str], seed: int = 3) -> Network:
    rng = np.random.default_rng(seed)
    f = FILTERS * len(WIDTHS)

    def draw(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return Network(langs, draw(256, BYTE_DIMS, scale=0.5), draw(max(WIDTHS) * BYTE_DIMS, f, scale=0.25) * _filter_mask(),
                   np.zeros(f, np.float32), draw(f, len(langs), scale=0.2), np.zeros(len(langs), np.float32))


def _filter_mask() -> np.ndarray:
    mask = np.zeros((max(WIDTHS) * BYTE_DIMS, FILTERS * len(WIDTHS)), dtype=np.float32)
    for i, width in enumerate(WIDTHS):
        mask[:width * BYTE_DIMS, i * FILTERS:(i + 1) * FILTERS] = 1
    return mask


def _patches(net: Network, windows: np.ndarray) -> np.ndarray:
    """windows x places x the bytes' vectors under the widest filter at that place."""
    v = net.bytes_[windows].reshape(len(windows), -1)
    places = windows.shape[1] - max(WIDTHS) + 1
    step = v.strides[1]
    return np.lib.stride_tricks.as_strided(
        v, (len(windows), places, max(WIDTHS) * BYTE_DIMS), (v.strides[0], BYTE_DIMS * step, step), writeable=False)


def _forward(net: Network, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(patches, answers of all filters at all places, softmax over languages)."""
    patches = _patches(net, windows)
    answers = patches.reshape(-1, patches.shape[2]) @ net.filters
    answers = answers.reshape(len(windows), -1, net.filters.shape[1])
    return patches, answers, _softmax(net, answers.max(axis=1))


def _softmax(net: Network, top: np.ndarray) -> np.ndarray:
    logits = np.maximum(top + net.bias, 0) @ net.dense + net.dense_bias
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _gradients(net: Network, windows: np.ndarray, wanted: np.ndarray) -> list[np.ndarray]:
    patches, answers, p = _forward(net, windows)
    n, f = len(windows), net.filters.shape[1]
    where = answers.argmax(axis=1)  # the place each filter keeps
    top = np.take_along_axis(answers, where[:, None, :], axis=1)[:, 0] + net.bias
    hidden = np.maximum(top, 0)
    d_logits = (p - wanted) / n
    d_top = (d_logits @ net.dense.T) * (top > 0)
    kept = patches[np.arange(n)[:, None], where]  # n x f x patch
    d_filters = np.einsum("nfp,nf->pf", kept, d_top) * _filter_mask()
    d_patches = d_top[:, :, None] * net.filters.T[None]  # n x f x patch
    d_bytes = np.zeros_like(net.bytes_)
    for j in range(max(WIDTHS)):
        under = windows[np.arange(n)[:, None], where + j]
        np.add.at(d_bytes, under.ravel(), d_patches[:, :, j * BYTE_DIMS:(j + 1) * BYTE_DIMS].reshape(n * f, BYTE_DIMS))
    return [d_bytes, d_filters, d_top.sum(axis=0), hidden.T @ d_logits, d_logits.sum(axis=0)]


def fit(windows: np.ndarray, langs: list[str], classes: np.ndarray, epochs: int = EPOCHS, batch: int = 64) -> Network:
    """A network trained on windows (rows of WINDOW bytes) and their class numbers."""
    net, rng = new_network(langs), np.random.default_rng(11)
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    share = np.bincount(classes, minlength=len(langs)) / max(1, len(classes))
    weight = np.where(share > 0, 1 / np.maximum(share * len(langs), 1e-9), 0).astype(np.float32)
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            # A rare language's rows count as much, in sum, as a common one's.
            rows = rows[rng.random(len(rows)) < np.minimum(1, weight[classes[rows]])] if epoch else rows
            if not len(rows):
                continue
            grads = _gradients(net, windows[rows], np.eye(len(langs), dtype=np.float32)[classes[rows]])
            step += 1
            for p, g, m, v in zip(net.parameters(), grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.004 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def cut(text: bytes) -> np.ndarray:
    """All windows of a text; the last one is padded with zeros."""
    n = -(-len(text) // WINDOW)
    return np.frombuffer(text.ljust(n * WINDOW, b"\0"), dtype=np.uint8).reshape(n, WINDOW)


def window_probabilities(net: Network, windows: np.ndarray) -> np.ndarray:
    parts = []
    for at in range(0, len(windows), WINDOWS_AT_ONCE):
        parts.append(_forward(net, windows[at:at + WINDOWS_AT_ONCE])[2])
    return np.concatenate(parts) if parts else np.zeros((0, len(net.langs)), np.float32)


def predict(net: Network, texts: list[bytes | None]) -> list[tuple[str, float]]:
    """(language, score) of each text, over all its windows."""
    cuts = [cut(t or b"") for t in texts]
    counts = np.array([len(c) for c in cuts])
    out: list[tuple[str, float]] = []
    at = 0
    while at < len(cuts):  # windows of several texts together, and one long text's apart
        upto = max(at + 1, at + int(np.searchsorted(np.cumsum(counts[at:]), 8 * WINDOWS_AT_ONCE)))
        windows = np.concatenate(cuts[at:upto])
        p = window_probabilities(net, windows)
        letters = np.concatenate([_LETTER[windows[i:i + 65_536]].sum(axis=1) for i in range(0, len(windows), 65_536)] or [np.zeros(0)])
        ends = np.cumsum(counts[at:upto])
        for a, b in zip(np.concatenate(([0], ends[:-1])), ends):
            total = letters[a:b].sum()
            if not total:
                out.append(("und", 0.0))
                continue
            mean = (p[a:b] * letters[a:b, None]).sum(axis=0, dtype=np.float64) / total
            best = int(mean.argmax())
            out.append((net.langs[best], float(min(1.0, max(0.0, mean[best])))))
        at = upto
    return out


def training_windows(docs: DataFrame, *, doc_id: str, text: str, lang: str, per_lang: int, max_train: int) -> pd.DataFrame:
    """(id, lang, piece): at most 2 * max_train windows of the sampled rows, on the driver."""
    pair = ["id", "lang"]
    named = docs.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang")).filter("id is not null and lang is not null")
    named = materialised(named.distinct(), "named")
    sizes = materialised(named.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "langs")
    # An id's hash as a share of all hashes, times its language's ids: about its rank
    # within the language, without bringing a language's rows together.
    share = F.shiftrightunsigned(F.xxhash64(F.lit(7), "id"), 11).cast("double") / float(1 << 53)
    ranked = with_lookup(named, sizes, ["lang"]).withColumn("rank", share * F.col("n"))
    chosen = ranked.filter(F.col("rank") < per_lang).orderBy("rank", *pair).limit(max_train).select(*pair)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    rows = rows.filter(F.col("text").rlike(r"\p{L}")).join(F.broadcast(chosen), pair)
    data = F.col("text").cast("binary")
    room = F.greatest(F.octet_length("text") - WINDOW, F.lit(0)) + 1
    pieces = F.array(*[F.substring(data, (F.pmod(F.xxhash64(F.lit(i), "id"), room) + 1).cast("int"), F.lit(WINDOW)) for i in (1, 2)])
    one = rows.groupBy(*pair).agg(F.min(F.struct(F.xxhash64("text").alias("hash"), pieces.alias("pieces"))).alias("first"))
    return one.select(*pair, F.explode("first.pieces").alias("piece")).toPandas()


def train(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = PER_LANG,
          max_train: int = MAX_TRAIN) -> Network | None:
    """A network learned from the texts and languages of ``docs``; None if there are none."""
    sample = training_windows(docs, doc_id=doc_id, text=text, lang=lang, per_lang=per_lang, max_train=max_train)
    if sample.empty:
        return None
    sample = sample.sort_values(["id", "lang", "piece"], kind="stable")
    langs = sorted(sample["lang"].unique())
    windows = np.stack([cut(bytes(p))[0] for p in sample["piece"]])
    return fit(windows, langs, np.searchsorted(langs, sample["lang"].to_numpy()))


def identify(docs: DataFrame, net: Network | None, *, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score."""
    if net is None:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})

    @F.pandas_udf("lang string, score double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(predict(net, list(texts)), columns=["lang", "score"])

    lettered: Column = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    found = docs.withColumn("__found", of(F.when(lettered, F.col(text).cast("binary"))))
    return found.withColumns({"lang_pred": F.col("__found.lang"), "score": F.col("__found.score")}).drop("__found")
