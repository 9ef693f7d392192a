"""Text quality by logistic regression over hashed word n-grams, trained with
follow-the-regularised-leader updates and scored as sparse dot products.

A text's words give 1- and 2-grams, and their shapes (upper, lower, digit and each mark,
runs as one) give 1- to 3-grams; whether a word repeats the one before it takes part as
well. All are hashed into ``1 << BITS`` places, counted over the whole text, damped by
log(1 + n) and scaled to length 1 within words and within shapes. The score is the
logistic of the sum of the weights of these places.

Training takes a bounded sample: the ``max_train`` labelled rows with the smallest hash of
their id. They are dealt to up to ``shards`` tasks, each of which goes through its rows
several times with per-coordinate FTRL-proximal updates; the shards' weights are averaged.

Defined cases: null and empty texts have no n-gram and are scored by the bias alone; rows
whose id is null are never trained on; labels other than 0 and 1 are left out, several
labels of one document count as their largest; repeated rows are scored alike; without any
label every score is 0.5; an empty table gives no rows; other columns are kept, but for
``score`` and ``predicted``, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.common import materialised

BITS = 18
MAX_TRAIN = 12_000
SHARDS = 4
SHARD_ROWS = 2_000  # of fewer than twice as many rows one shard is made
VISITS = 12_000  # of rows in a shard, over all its epochs
CHUNK = 1 << 20  # bytes of a text hashed at once
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.005, 0.05

_U = np.uint64
_RANDOM = np.random.default_rng(2024).integers(1, 1 << 63, size=64, dtype=np.uint64) | _U(1)


def _classes() -> np.ndarray:
    """A class per byte: blank 0, lower case and bytes beyond ASCII 1, upper case 2, digit
    3, every other byte its own."""
    c = np.arange(256, dtype=np.uint8)
    c[c < 4] = 4
    c[ord("a"):ord("z") + 1] = 1
    c[128:] = 1
    c[ord("A"):ord("Z") + 1] = 2
    c[ord("0"):ord("9") + 1] = 3
    c[[32, 9, 10, 11, 12, 13]] = 0
    return c


_CLASS = _classes()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    return h ^ (h >> _U(29))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, hash of its shape) of a chunk of bytes: sums of bytes times a
    random number for their place in the word (or in its run of classes)."""
    cls = _CLASS[data]
    inside = np.concatenate(([False], cls != 0, [False]))
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    if not len(starts):
        none = np.empty(0, dtype=np.uint64)
        return none, none
    ends = np.flatnonzero(~inside[1:] & inside[:-1])
    at = np.flatnonzero(cls)
    lengths = ends - starts
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))  # of each word among ``at``
    place = np.arange(len(at)) - np.repeat(first, lengths)
    words = np.add.reduceat((data[at].astype(np.uint64) + _U(1)) * _RANDOM[place & 63], first)
    own = cls[at]
    turn = np.ones(len(at), dtype=bool)
    turn[1:] = own[1:] != own[:-1]
    turn[first] = True
    run = np.cumsum(turn)
    run = run - np.repeat(run[first], lengths)
    shapes = np.add.reduceat(np.where(turn, (own.astype(np.uint64) + _U(3)) * _RANDOM[run & 63], _U(0)), first)
    return _mix(words + lengths.astype(np.uint64)), _mix(shapes)


def _chunks(text: bytes) -> Iterator[bytes]:
    """The text in parts of about CHUNK bytes, cut at blanks; a longer word stays whole."""
    start = 0
    while start < len(text):
        end = start + CHUNK
        while end < len(text) and _CLASS[text[end]] != 0:
            end += 1
        yield text[start:end]
        start = end


def _counted(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return np.unique(parts[0], return_counts=True)
    keys, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(inverse, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)


def features(text: bytes | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(places, values) of a text's n-grams; place 0 is the bias, with value 1."""
    mask = _U((1 << bits) - 1)
    groups: tuple[list, list] = ([], [])
    tail = [np.zeros(2, dtype=np.uint64), np.zeros(2, dtype=np.uint64)]  # the two words before
    for part in _chunks(text or b""):
        words, shapes = word_hashes(np.frombuffer(part, dtype=np.uint8))
        if not len(words):
            continue
        w, s = np.concatenate((tail[0], words)), np.concatenate((tail[1], shapes))
        tail = [w[-2:], s[-2:]]
        same = np.where(w[2:] == w[1:-1], _U(11), _U(13))
        word_grams = [w[2:], _mix(w[2:] * _U(3) + w[1:-1])]
        shape_grams = [s[2:] + _U(1), _mix(s[2:] * _U(5) + s[1:-1]), _mix(s[2:] * _U(7) + s[1:-1] * _U(3) + s[:-2]), _mix(same)]
        for group, grams in zip(groups, (word_grams, shape_grams)):
            group.append(np.unique(np.concatenate(grams) & mask, return_counts=True))
    places, values = [np.zeros(1, dtype=np.int64)], [np.ones(1)]
    for group in groups:
        if group:
            keys, counts = group[0] if len(group) == 1 else _counted(group)
            value = np.log1p(counts)
            places.append(keys.astype(np.int64))
            values.append(value / np.sqrt((value**2).sum()))
    return np.concatenate(places), np.concatenate(values)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int, epochs: int) -> np.ndarray:
    """Weights after ``epochs`` passes of FTRL-proximal over (places, values, label)."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)

    def weights(i) -> np.ndarray:
        return np.where(np.abs(z[i]) <= L1, 0.0, (np.sign(z[i]) * L1 - z[i]) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    for _ in range(epochs):
        for i, x, y in rows:
            w = weights(i)
            gap = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35))) - y
            g = gap * x
            more = n[i] + g * g
            z[i] += g - (np.sqrt(more) - np.sqrt(n[i])) / ALPHA * w
            n[i] = more
    return weights(slice(None))


def train(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          max_train: int = MAX_TRAIN, shards: int = SHARDS, bits: int = BITS) -> np.ndarray:
    """Weights learned from the texts of ``docs`` and ``labels`` (doc_id, label 0 or 1)."""
    order = F.xxhash64(F.lit(9), "id")
    chosen = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y"))
    chosen = chosen.filter(F.col("id").isNotNull() & F.col("y").isin(0, 1)).groupBy("id").agg(F.max("y").alias("y"))
    chosen = materialised(chosen.orderBy(order, "id").limit(max_train), "labelled")  # so many rows at most are broadcast
    n = chosen.count()
    shards = max(1, min(shards, n // SHARD_ROWS))
    epochs = max(3, VISITS * shards // max(1, n))
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("text")).join(F.broadcast(chosen), "id")
    # One text an id, that with the smallest hash, so the sample is bounded where ids repeat.
    rows = rows.groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = rows.withColumn("shard", F.pmod(order, F.lit(shards)))

    def fit(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["id", "text"], kind="stable")
        shard = shard.iloc[np.random.default_rng(7).permutation(len(shard))]
        w = ftrl([(*features(t, bits), y) for t, y in zip(shard["text"], shard["y"])], bits, epochs)
        at = np.flatnonzero(w)
        return pd.DataFrame({"place": at, "weight": w[at]})

    parts = rows.groupBy("shard").applyInPandas(fit, "place long, weight double")
    mean = parts.groupBy("place").agg(F.array_sort(F.collect_list("weight")).alias("w"))  # one entry a shard
    weights = np.zeros(1 << bits, dtype=np.float64)
    for r in mean.toPandas().itertuples():  # 1 << bits rows at most
        weights[r.place] = sum(r.w) / shards
    return weights


def score(text: Column, weights: np.ndarray) -> Column:
    """The probability of label 1 of a string column's texts."""
    bits = len(weights).bit_length() - 1

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            dots = [weights[i] @ x for i, x in (features(t, bits) for t in texts)]
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(np.array(dots, dtype=np.float64), -35, 35))))

    return of(text.cast("binary"))


def classify(docs: DataFrame, weights: np.ndarray, *, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 if score >= threshold, else 0)."""
    scored = docs.withColumn("score", score(F.col(text), weights))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
