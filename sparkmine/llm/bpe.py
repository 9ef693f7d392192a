"""Byte-level BPE encoding and decoding; the merges of a corpus's frequent words are folds
of Spark's higher-order functions.

A text is split by a pattern into words, each of which is encoded by itself: its bytes'
tokens are folded by ranked merges, the lowest rank first and of equal ones the leftmost,
until no two neighbours make a token. The ranks are a literal map from pairs of tokens to
the token they make. Decoding looks up each token's bytes and concatenates them.

The distinct words of the whole corpus are counted, and the most frequent of them are
folded once; their tokens become a table of bounded size that is sent to the tasks. There
the texts are split, on Arrow batches, and every word is looked up. A word that isn't in
the table is merged where it occurs, by the same rule and with the same result, and kept
for a while. So the table saves work but never decides a result, and no occurrence of a
word is shuffled. Ids and digests are made in one pass over the texts; a Python worker
reads the table once for all of its tasks.

The literal map is two literal arrays of prime lengths; an entry stands at its key modulo
the first length or at its key modulo the second, so that two reads find it or show that
it isn't there. Each literal stands in a plan once and is bound to a lambda's variable.

Defined cases: null text is encoded as empty text (no ids); repeated rows are encoded
alike; an empty table gives no rows; other columns are kept but for those that are
returned.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import uuid
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmine.llm.common import let, materialised

TABLE_WORDS = 400_000
TABLE_WORD_BYTES = 48
KEPT_WORDS = 100_000  # rarer words that a task keeps
SHORT_WORD = 40  # bytes up to which looking through all pairs is faster than a heap
ROWS_AT_ONCE = 256
RANK_BITS = 20  # a literal entry is key << RANK_BITS | rank


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def next_prime(n: int) -> int:
    while not is_prime(n):
        n += 1
    return n


def literal(values: list, kind: str) -> Column:
    """A literal array; the optimiser parses the text once, not for each row."""
    return F.from_json(F.lit(json.dumps(values, separators=(",", ":"))), kind)


def two_places(entries: list[tuple[int, object]], load: float = 1.4) -> tuple[list, list]:
    """Two arrays; each (key, entry) stands at key modulo the length of one of them. An
    entry that finds its place taken moves the one there to its other place, and so on;
    if that doesn't end, the arrays grow."""
    while True:
        first = next_prime(int(load * len(entries)) + 7)
        tables: list[list] = [[None] * first, [None] * next_prime(first + 1)]
        for item in entries:
            for turn in range(400):
                table = tables[turn % 2]
                at = item[0] % len(table)
                item, table[at] = table[at], item
                if item is None:
                    break
            if item is not None:
                break
        else:
            return tuple([e and e[1] for e in t] for t in tables)
        load *= 1.3


@dataclass(frozen=True)
class Ranks:
    """A vocabulary: each token's bytes by its rank, which is also its id."""

    tokens: tuple[bytes, ...]

    @staticmethod
    def read(path: str) -> Ranks:
        """Lines of base64 bytes and rank, as tiktoken files have them; on the driver."""
        with open(path, "rb") as lines:
            found = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
        if sorted(found) != list(range(len(found))) or len(found) >= 1 << RANK_BITS:
            raise ValueError("ranks must be 0, 1, 2, ...")
        return Ranks(tuple(found[i] for i in range(len(found))))

    @cached_property
    def of(self) -> dict[bytes, int]:
        return {token: rank for rank, token in enumerate(self.tokens)}

    @cached_property
    def pairs(self) -> list[tuple[int, int]]:
        """(left << RANK_BITS | right, rank of both together) for all pairs of tokens that
        make a token."""
        return [
            (self.of[t[:i]] << RANK_BITS | self.of[t[i:]], rank)
            for rank, t in enumerate(self.tokens) for i in range(1, len(t)) if t[:i] in self.of and t[i:] in self.of]

    def encode_word(self, word: bytes) -> list[int]:
        """The ids of one word, merged outside of Spark's expressions."""
        if word in self.of:
            return [self.of[word]]
        return self._merge_short(word) if len(word) <= SHORT_WORD else self._merge_long(word)

    def _merge_short(self, word: bytes) -> list[int]:
        rank, none = self.of.get, len(self.tokens)
        parts = [word[i:i + 1] for i in range(len(word))]
        pairs = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs and (best := min(pairs)) < none:
            i = pairs.index(best)
            both = parts[i] + parts[i + 1]
            parts[i:i + 2] = [both]
            pairs[i:i + 2] = [rank(both + parts[i + 1], none)] if i + 1 < len(parts) else []
            if i:
                pairs[i - 1] = rank(parts[i - 1] + both, none)
        return [self.of[p] for p in parts]

    def _merge_long(self, word: bytes) -> list[int]:
        """By a heap of pairs, for words whose length squared would be too much."""
        ends = list(range(1, len(word) + 1))  # of the token that starts here; 0: none does
        before = list(range(-1, len(word)))
        heap: list[tuple[int, int, int]] = []

        def offer(start: int) -> None:
            middle = ends[start]
            if middle < len(word) and (rank := self.of.get(word[start:ends[middle]])) is not None:
                heapq.heappush(heap, (rank, start, ends[middle]))

        for i in range(len(word)):
            offer(i)
        while heap:
            _, start, end = heapq.heappop(heap)
            middle = ends[start]
            if not middle or middle >= len(word) or ends[middle] != end:
                continue  # one of its tokens has changed since
            ends[start], ends[middle] = end, 0
            before[end] = start
            offer(start)
            if before[start] >= 0:
                offer(before[start])
        ids, at = [], 0
        while at < len(word):
            ids.append(self.of[word[at:ends[at]]])
            at = ends[at]
        return ids


@dataclass(frozen=True)
class Tables:
    """The literal arrays of the rank map, bound once by each expression."""

    pairs: tuple[list, list]
    single: list[int]  # the token of each byte

    @staticmethod
    def of(ranks: Ranks) -> Tables:
        pairs = two_places([(key, key << RANK_BITS | rank) for key, rank in ranks.pairs])
        return Tables(pairs, [ranks.of[bytes([i])] for i in range(256)])

    def bind(self, use: Callable[[Column], Column]) -> Column:
        """``use(tables)`` with the arrays as fields of one struct."""
        return let(F.struct(literal(self.pairs[0], "array<bigint>").alias("pairs_1"), literal(self.pairs[1], "array<bigint>").alias("pairs_2"),
                            literal(self.single, "array<int>").alias("single")), use)

    def rank(self, tables: Column, a: Column, b: Column) -> Column:
        """The rank of the token that two tokens make, or null. Null if one of them is.
        The reads are repeated instead of bound: binding costs more."""
        key = F.shiftleft(a.cast("long"), RANK_BITS).bitwiseOR(b)

        def entry(i: int) -> Column:
            return F.get(tables[f"pairs_{i}"], (key % len(self.pairs[i - 1])).cast("int"))

        def rank(i: int) -> Column:
            return entry(i).bitwiseAND(F.lit((1 << RANK_BITS) - 1)).cast("int")

        found = F.when(F.shiftright(entry(1), RANK_BITS) == key, rank(1))
        return found.when(F.shiftright(entry(2), RANK_BITS) == key, rank(2))


def fold_word(maps: Tables, tables: Column, word: Column) -> Column:
    """The ids of one word (a string column) as an array, by ranked merges."""
    latin = F.decode(word.cast("binary"), "ISO-8859-1")  # a character for each byte

    def singles(chars: Column) -> Column:
        spots = F.sequence(F.lit(1), F.length(chars))
        return F.transform(spots, lambda i: F.get(tables["single"], F.ascii(F.substring(chars, i, F.lit(1)))))

    def state(ids: Column, pairs: Column) -> Column:
        return F.struct(ids.alias("ids"), pairs.alias("pairs"))

    def begin(ids: Column) -> Column:
        return state(ids, F.zip_with(ids, F.slice(ids, F.lit(2), F.size(ids)), lambda a, b: maps.rank(tables, a, b)))

    def merge(s: Column, _: Column) -> Column:
        ids, pairs = s["ids"], s["pairs"]  # pairs[i]: the rank of ids[i] with ids[i + 1]

        def at(best: Column) -> Column:
            def joined(p: Column) -> Column:  # p from 1; the new token's id is its rank
                n = F.size(ids)
                new_ids = F.concat(F.slice(ids, F.lit(1), p - 1), F.array(best), F.slice(ids, p + 2, n))
                sides = F.slice(F.array(maps.rank(tables, F.get(ids, p - 2), best), maps.rank(tables, best, F.get(ids, p + 1))),
                                F.when(p == 1, F.lit(2)).otherwise(F.lit(1)), F.lit(2))
                return state(new_ids, F.concat(
                    F.slice(pairs, F.lit(1), F.greatest(p - 2, F.lit(0))), sides, F.slice(pairs, p + 2, n)))

            return F.when(best.isNull(), s).otherwise(let(F.array_position(pairs, best).cast("int"), joined))

        return let(F.array_min(pairs), at)

    def run(ids: Column) -> Column:
        return F.aggregate(F.slice(ids, F.lit(2), F.size(ids)), begin(ids), merge)["ids"]

    whole = let(let(latin, singles), run)
    return F.when(F.octet_length(word) == 0, F.array().cast("array<int>")).otherwise(whole)


def split_words(text: Column, pattern: str) -> Column:
    """All matches of ``pattern``, with \\s as Unicode's white space."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?U)" + pattern), F.lit(0))


def frequent_words(docs: DataFrame, text: str, pattern: str, limit: int) -> DataFrame:
    """(word, n) of the most frequent distinct words, about ``limit`` at most: those above
    the count that leaves so many, which a small histogram of all counts tells, and of the
    next step of counts a share by a hash."""
    words = docs.select(F.explode(split_words(F.col(text), pattern)).alias("word"))
    counts = words.filter(F.octet_length("word") <= TABLE_WORD_BYTES).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counts = materialised(counts.filter("n > 1"), "words")
    step = F.floor(F.log2("n") * 16).cast("int")  # under 1000 steps
    room, least, share = limit, 0, 0.0
    for row in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        if row["count"] > room:
            least, share = row["step"] + 1, room / row["count"]
            break
        room -= row["count"]
    parts = 1 << 20
    return counts.filter((step >= least) | ((step == least - 1) & (F.pmod(F.xxhash64("word"), F.lit(parts)) < int(share * parts))))


def frequent_ids(words: DataFrame, maps: Tables) -> bytes:
    """The words and their ids as an Arrow stream: a table of bounded size, which the
    driver never holds as objects."""
    folded = words.select("word", maps.bind(lambda t: fold_word(maps, t, F.col("word"))).alias("ids"))
    rows = folded.toArrow()
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema) as stream:
        stream.write_table(rows)
    return out.getvalue().to_pybytes()


def read_ids(stream: bytes) -> dict[str, bytes]:
    """The ids of ``frequent_ids``, as 32-bit integers, by word."""
    found: dict[str, bytes] = {}
    for rows in pa.ipc.open_stream(stream):
        ends, values = rows["ids"].offsets.to_numpy(), rows["ids"].values.to_numpy().astype("<i4")
        found.update((w, values[a:b].tobytes()) for w, a, b in zip(rows["word"].to_pylist(), ends, ends[1:]))
    return found


class _Lookup(dict):
    """Words' ids; ``rarer`` gives those of a word that isn't there."""

    def __init__(self, table: dict[str, bytes], rarer: Callable[[str], bytes]):
        super().__init__(table)
        self.rarer = rarer

    def __missing__(self, word: str) -> bytes:
        return self.rarer(word)


class Encoder:
    """Encodes texts in a worker: the table, and the rarer words that it has met, are kept."""

    def __init__(self, ranks: Ranks, pattern: str, table: dict[str, bytes]):
        import regex

        # \\s is what Unicode calls white space; the controls 1C to 1F aren't.
        pattern = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.words = regex.compile(pattern).findall
        self.ranks, self.kept = ranks, {}
        self.ids_of = _Lookup(table, self.rarer).__getitem__
        self.bytes_of = ranks.tokens.__getitem__

    def rarer(self, word: str) -> bytes:
        ids = self.kept.get(word)
        if ids is None:
            if len(self.kept) >= KEPT_WORDS:
                self.kept.clear()
            ids = array("i", self.ranks.encode_word(word.encode())).tobytes()
            if len(word) <= TABLE_WORD_BYTES:
                self.kept[word] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.ids_of, self.words(text))), dtype="<i4")

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids' tokens, concatenated."""
        return b"".join(map(self.bytes_of, ids.tolist()))


GIVES = {"ids": "array<int>", "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
_ENCODER: dict[str, Encoder] = {}  # of this worker: the one that it used last


def _encoder(key: str, made: Callable[[], Encoder]) -> Encoder:
    if key not in _ENCODER:
        _ENCODER.clear()
        _ENCODER[key] = made()
    return _ENCODER[key]


def _columns(encoder: Encoder, texts: list[str | None], give: tuple[str, ...]) -> list[pa.Array]:
    """The columns ``give`` of some texts."""
    rows = [encoder.encode(t or "") for t in texts]
    made: list[pa.Array] = []
    for name in give:
        if name == "ids":
            ends = np.cumsum([0, *map(len, rows)], dtype=np.int64).astype(np.int32)
            made.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows) if rows else np.zeros(0, "<i4"), pa.int32())))
        elif name == "n_tokens":
            made.append(pa.array([len(r) for r in rows], pa.int64()))
        else:
            data = map(encoder.decode, rows) if name == "decoded_sha256" else map(little_endian, rows)
            made.append(pa.array([hashlib.sha256(d).hexdigest() for d in data], pa.string()))
    return made


def encode(docs: DataFrame, ranks: Ranks, pattern: str, *, text: str = "text", table_words: int = TABLE_WORDS,
           give: tuple[str, ...] = ("ids",)) -> DataFrame:
    """``docs`` with the columns ``give``: ``ids``, the token ids of the whole text as an
    array<int>; ``n_tokens``, their number; ``ids_sha256``, the digest of the ids as
    little-endian unsigned 32-bit integers; ``decoded_sha256``, that of the bytes which the
    ids decode to. All are made in one pass."""
    words = frequent_words(docs, text, pattern, table_words)
    shared = docs.sparkSession.sparkContext.broadcast((ranks.tokens, frequent_ids(words, Tables.of(ranks))))
    key = uuid.uuid4().hex

    def made() -> Encoder:
        tokens, table = shared.value
        return Encoder(Ranks(tokens), pattern, read_ids(table))

    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(key, made)
        for texts in batches:
            for at in range(0, len(texts), ROWS_AT_ONCE):
                yield pa.StructArray.from_arrays(_columns(encoder, texts[at:at + ROWS_AT_ONCE].to_pylist(), give), names=list(give))

    found.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    of = F.arrow_udf(found, ", ".join(f"{name} {GIVES[name]}" for name in give))
    encoded = docs.withColumn("__encoded", of(F.col(text)))
    return encoded.withColumns({name: F.col("__encoded")[name] for name in give}).drop("__encoded")


def little_endian(ids: np.ndarray) -> bytes:
    """The ids as little-endian unsigned 32-bit integers."""
    return np.asarray(ids).astype("<u4").tobytes()


def decode(ids: np.ndarray, tokens: tuple[bytes, ...]) -> bytes:
    """The bytes of the ids' tokens, concatenated."""
    return b"".join([tokens[i] for i in np.asarray(ids).tolist()])


def decoded(encoded: DataFrame, ranks: Ranks, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``decoded``, the bytes that the row's ids stand for."""
    tokens = ranks.tokens
    kept = encoded.select(*keep)
    schema = T.StructType([*kept.schema.fields, T.StructField("decoded", T.BinaryType())])

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.iloc[at:at + ROWS_AT_ONCE]
                yield part[list(keep)].assign(decoded=[decode(ids, tokens) for ids in part["__ids"]])

    return encoded.select(*keep, F.col("ids").alias("__ids")).mapInPandas(rows, schema)
