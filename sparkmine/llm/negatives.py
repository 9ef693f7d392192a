"""Hard negatives of anchors by Kronecker-packed products.

An anchor's score with a row is the integer inner product of their scaled, floored
components. The rows of a block are biased by the block's least component, so that all
components are at least zero, and several rows' j-th components are put side by side into
fields of one wide integer. One multiplication by an anchor's j-th component multiplies all
of them; the sums over j then hold one biased score in each field. Adding a constant makes
the fields non-negative, they are cut out, and the biases are taken off: exact scores.
Fields are as wide as the largest possible biased score, by Cauchy and Schwarz over the
block's and the anchors' lengths; machine words hold as many as 63 bits take, and where that
is but one, the same is done on Python's unbounded integers, ``LONG_FIELDS`` to each.

The anchors are a stated query set, and every row meets every anchor once in each of two
passes: one finds the positives, the other, knowing their scores, the negatives. Rows are
dealt to blocks by a hash of all they hold and their number, so copies spread; a task holds
one block of bounded bytes and one part of the anchors, scores them ``SCORES`` at a time
and returns a few rows an anchor.

Defined cases: rows with a null id or label, a null or empty vector, a null or non-finite
component, another number of components than most (of equal counts the larger), or a squared
length of 2**56 or more (100 times a score wouldn't fit a long) take no part; an anchor row
that is repeated whole asks once, but its copies, like all repeated rows, are found one by
one; rows with the anchor's id are never its positives, rows of another label with it may be
its negatives; an anchor without positives, or a positive without negatives, has no row; an
empty table gives none; columns beyond id, label and vector aren't read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.llm.clusters import quantised, usable
from sparkmine.llm.common import materialised

BLOCK_BYTES = 8 << 20
LEAST_BLOCKS = 24  # so that a small table is spread over tasks too
SCORES = 1 << 20  # scores held at once
LONG_FIELDS = 64


def field_bits(anchors: np.ndarray, biased: np.ndarray) -> int:
    """Bits that hold every product of an anchor and a biased row, plus a sign."""

    def longest(m: np.ndarray) -> int:
        return int(np.ceil(np.sqrt(np.square(m.astype(np.float64)).sum(axis=1)).max() * (1 + 1e-9))) if len(m) else 0

    return (2 * (longest(anchors) * longest(biased) + 1)).bit_length()


def packed(biased: np.ndarray, bits: int) -> tuple[np.ndarray, int]:
    """(integers of a number of rows' components side by side: groups x components, rows
    to a group). Row g of group i is row ``i * fields + g``."""
    fields, kind = (63 // bits, np.int64) if bits <= 31 else (LONG_FIELDS, object)
    groups = -(-len(biased) // fields)
    rows = np.zeros((groups * fields, biased.shape[1]), dtype=kind)
    rows[:len(biased)] = biased
    rows = rows.reshape(groups, fields, -1)
    return sum(rows[:, g] << (g * bits) for g in range(fields)), fields


class Packed:
    """A block's rows, packed for a set of anchors."""

    def __init__(self, z: np.ndarray, anchors: np.ndarray):
        self.rows, self.bias = len(z), int(z.min())
        biased = z - self.bias
        self.bits = field_bits(anchors, biased)
        self.words, self.fields = packed(biased, self.bits)
        # Half of every field, so that no field borrows from the next.
        self.half = 1 << (self.bits - 1)
        self.halves = sum(self.half << (g * self.bits) for g in range(self.fields))

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """rows x anchors, exact."""
        asked = anchors.astype(self.words.dtype)
        sums = self.words @ asked.T + self.halves  # one multiplication a component and group
        mask = (1 << self.bits) - 1
        each = np.stack([(sums >> (g * self.bits)) & mask for g in range(self.fields)], axis=1)
        out = each.reshape(-1, len(anchors))[:self.rows] - self.half + self.bias * asked.sum(axis=1)[None, :]
        return out.astype(np.int64)


def best_rows(score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest; of equal ones the earlier."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= least)
    else:
        at = np.arange(len(score))
    return at[np.argsort(-score[at], kind="stable")[:k]]


def _meet(pick: Callable[[pd.Series, pd.DataFrame, np.ndarray], Iterator[tuple]], columns: list[str]):
    def meet(block: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(block) and len(asking):
            block = block.sort_values("id", kind="stable").reset_index(drop=True)
            asking = asking.reset_index(drop=True)
            z, a = (np.array(x["z"].tolist(), dtype=np.int64) for x in (block, asking))
            rows = Packed(z, a)
            some = max(1, SCORES // len(block))
            for at in range(0, len(a), some):
                scores = rows.scores(a[at:at + some])
                for i in range(scores.shape[1]):
                    out += pick(asking.iloc[at + i], block, scores[:, i])
        return pd.DataFrame(out, columns=columns)

    return meet


def _positives(k: int):
    def pick(anchor: pd.Series, block: pd.DataFrame, score: np.ndarray) -> Iterator[tuple]:
        own = np.flatnonzero((block["label"].to_numpy() == anchor["label"]) & (block["id"].to_numpy() != anchor["id"]))
        for i in own[best_rows(score[own], k)]:
            yield anchor["key"], block["id"].iat[i], score[i]

    return _meet(pick, ["key", "found", "score"])


def _negatives(k: int, low: int, high: int):
    def pick(anchor: pd.Series, block: pd.DataFrame, score: np.ndarray) -> Iterator[tuple]:
        other = block["label"].to_numpy() != anchor["label"]
        for place, least in enumerate(anchor["scores"]):
            own = np.flatnonzero(other & (100 * score >= low * least) & (100 * score <= high * least))
            for i in own[best_rows(score[own], k)]:
                yield anchor["key"], place, block["id"].iat[i], score[i]

    return _meet(pick, ["key", "place", "found", "score"])


def hard_negatives(rows: DataFrame, is_anchor: Column, *, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
                   scale: int = 256, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """For each anchor (``is_anchor``: a condition on the long column ``id``) and each of its
    ``positives`` best rows of the same label, the ``negatives`` best rows of other labels
    whose score lies between ``low`` and ``high`` hundredths of the positive's: anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score."""
    v = F.col(vector)
    fine = rows.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                       F.when(usable(v, scale, 56) & (F.size(v) > 0), quantised(v, scale).cast("array<int>")).alias("z"))
    fine = fine.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("z").isNotNull())
    lengths = fine.groupBy(F.size("z").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dims, count = (lengths["d"], lengths["count"]) if lengths else (1, 0)
    fine = fine.filter(F.size("z") == dims)
    row_bytes = 8 * dims
    blocks = max(LEAST_BLOCKS, -(-count * row_bytes // BLOCK_BYTES))
    whole = F.xxhash64(F.lit(11), "id", "label", "z")
    anchors = materialised(fine.filter(is_anchor).withColumn("key", whole).dropDuplicates(["key"]), "anchors")
    parts = max(1, -(-anchors.count() * row_bytes // BLOCK_BYTES))
    # Copies differ in nothing but their number, which is that of a row in its split of the
    # scan: it is the same when a task is run again.
    number = F.monotonically_increasing_id()
    dealt = fine.withColumn("block", F.pmod(F.xxhash64(whole, number), F.lit(blocks)).cast("int"))
    dealt = materialised(dealt, "rows").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def met(asking: DataFrame, meet, schema: str) -> DataFrame:
        asking = asking.withColumn("part", F.pmod(F.col("key"), F.lit(parts)).cast("int"))
        asking = asking.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        return dealt.groupBy("block", "part").cogroup(asking.groupBy("block", "part")).applyInPandas(meet, schema)

    def ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc("found"))
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    best = ranked(met(anchors, _positives(positives), "key long, found long, score long"), ["key"], positives)
    # At most ``positives`` entries an anchor.
    lists = best.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("rank", F.col("found").alias("id"), "score"))).alias("best"))
    asking = materialised(anchors.join(lists, "key"), "positives")
    found = met(asking.select("key", "id", "label", "z", F.col("best.score").alias("scores")), _negatives(negatives, low, high),
                "key long, place int, found long, score long")
    named = ranked(found, ["key", "place"], negatives).join(asking.select("key", F.col("id").alias("anchor_id"), "best"), "key")
    positive = F.get("best", F.col("place"))
    return named.select("anchor_id", positive["id"].alias("positive_id"), "rank", F.col("found").alias("negative_id"),
                        positive["score"].alias("positive_score"), F.col("score").alias("negative_score"))
