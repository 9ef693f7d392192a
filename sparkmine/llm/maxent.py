"""Language-model scores of texts by a hashed maximum-entropy model with a class-factored
softmax: P(token | history) = P(class | history) * P(token | class, history).

Tokens: the words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lowered, then one end. All
training documents are counted, word by word. The most frequent ``SOFTMAX_WORDS`` tokens
fall, by rank, into classes of ``CLASS_WORDS``; every other word, known or not, into one of
``RARE_CLASSES`` by its last two bytes. The history's features are the token before (n-gram
of one), the two before (n-gram of two), and, as skips, the second and the third before.
Each is hashed to a row of weights, one weight a class; with the token's class it is hashed
to a row of the second table, one weight a member. Logits are sums of rows and of a bias
that starts at the logarithm of the counts. Inside a class of rare words a word has its
share of the class's training counts, (c + 1) / (tokens + words + 1), where one share is
left for all unknown words: so the probabilities of all known tokens and of "an unknown
word", class by class, add up to 1.

Training goes once over all training documents, in ``ROUNDS`` disjoint parts by a hash of
the text. In each round every task takes minibatches of its rows through AdaGrad updates
(one step size a row of weights) and returns the rows that it touched; a row's new weights
are the tasks' mean, weighted by how much each moved its step size. (Tasks send changes in half precision.) Scores are made in
batches: rows of weights are gathered for the features that occur, and softmaxed.

The exact counts of all words grow with the corpus and never leave Spark: tasks hold those
of about the ``TABLE_WORDS`` most frequent ones, and each document's other words meet theirs in a
join. A word outside the table makes up about 1 / TABLE_WORDS of all tokens at most, so no key
is hot.

Defined cases: null and empty texts are the end alone; documents without an id aren't held
out by the queries, and learned from like others; repeated rows are scored, and count, each
by itself; an empty table gives no rows; without training documents every class is equally
likely; a text is split in parts at blanks, so long ones take bounded memory (a word stays
whole); of the other columns those named in ``keep`` are returned.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.common import materialised

END = b" "  # no word holds a blank
TABLE_WORDS = 131_072
SOFTMAX_WORDS = 4_096
CLASS_WORDS = 64
RARE_CLASSES = 32
CLASS_ROWS = 1 << 14  # powers of two
WORD_ROWS = 1 << 15
ROUNDS = 3
SHARD_TOKENS = 6_000_000  # that a task trains on in a round
BATCH = 8_192  # tokens of an update
SCORED = 2_048  # tokens scored at once
PIECE = 65_536  # tokens looked up at once
LIMIT = 80.0  # of a logit
SHORT = 64  # entries that are summed with others'
STEP = 1.0
CHUNK = 1 << 20  # bytes of a text split at once
COUNTED = 400_000  # distinct words that a task holds before it passes them on
BLOCK = 32  # rows of weights that are merged at once
NEAR = 512  # rows gathered at once, which stay in a core's cache

_U = np.uint64
_BLANK = b" \t\n\x0b\x0c\r"


def _chunks(text: bytes) -> Iterator[bytes]:
    """The text in parts of about CHUNK bytes, cut at blanks."""
    start = 0
    while start < len(text):
        end = start + CHUNK
        while end < len(text) and text[end] not in _BLANK:
            end += 1
        yield text[start:end]
        start = end


def tokens(text: bytes | None) -> Iterator[list[bytes]]:
    """The tokens of a text, part by part; the last part ends with END."""
    part: list[bytes] = []
    for chunk in _chunks(text or b""):
        if part:
            yield part
        part = chunk.lower().split()  # of bytes: A-Z, and the blanks named above
    yield part + [END]


# ---- counts ----------------------------------------------------------------------------


def word_counts(texts: DataFrame) -> DataFrame:
    """(word binary, n long) over all rows of ``texts`` (text binary)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                for part in tokens(text):
                    held.update(part)
                    if len(held) > COUNTED:
                        yield pd.DataFrame({"word": list(held), "n": list(held.values())})
                        held = Counter()
        yield pd.DataFrame({"word": list(held), "n": list(held.values())})

    return texts.mapInPandas(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def rare_class(word: bytes) -> int:
    return (word[-1] * 31 + (word[-2] if len(word) > 1 else 0) * 17) % RARE_CLASSES


def rare_classes(words: list[bytes]) -> np.ndarray:
    """``rare_class`` of each word."""
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end, line = np.cumsum(size), np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
    return (line[end - 1] * 31 + np.where(size > 1, line[end - 2], 0) * 17) % RARE_CLASSES


class Vocabulary(NamedTuple):
    """What tasks know of the counts; its size doesn't grow with the corpus."""

    words: list[bytes]  # by count, then bytes; END among them
    counts: np.ndarray
    train_tokens: int
    train_words: int
    rare_tokens: np.ndarray  # of each rare class
    rare_words: np.ndarray

    @property
    def softmax_classes(self) -> int:
        return -(-min(len(self.words), SOFTMAX_WORDS) // CLASS_WORDS)

    @property
    def classes(self) -> int:
        return self.softmax_classes + RARE_CLASSES

    def biases(self) -> tuple[np.ndarray, np.ndarray]:
        """(of each class, of each class's members): logarithms of the counts."""
        head = np.zeros(self.softmax_classes * CLASS_WORDS)
        n = min(len(self.words), SOFTMAX_WORDS)
        head[:n] = self.counts[:n]
        head = head.reshape(-1, CLASS_WORDS)
        with np.errstate(divide="ignore"):
            members = np.log(head)  # -inf where a class has no such member
        return np.log(np.concatenate([head.sum(axis=1), self.rare_tokens + 1.0])).astype(np.float32), members.astype(np.float32)


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """About the ``most`` most frequent words, and not more: those whose count is above a
    threshold, and of those at it (counts within a hundredth) a share by hash."""
    step = F.floor(F.log2("n") * 64).cast("int")  # 64 * 64 steps at most
    steps = sorted(((r["step"], r["count"]) for r in counts.groupBy(step.alias("step")).count().collect()), reverse=True)
    room, least, share = most, -1, 0.0
    for at, words in steps:
        if words > room:
            least, share = at, 0.95 * room / words
            break
        room -= words
    place = F.pmod(F.xxhash64(F.lit(29), "word"), F.lit(1 << 20))
    return counts.filter((step > least) | ((step == least) & (place < int(share * (1 << 20)))))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From the counted words, written as a table. The sums over the rare classes are
    those over all words, less those of the softmax's."""
    top = frequent(counts, TABLE_WORDS).toPandas()
    top["word"] = [bytes(w) for w in top["word"]]
    top = top.sort_values(["n", "word"], ascending=[False, True])
    words = top["word"].tolist()
    size = F.octet_length("word")

    def byte(at: Column) -> Column:  # of the word, as a number
        return F.conv(F.hex(F.substring("word", at, F.lit(1))), 16, 10).cast("int")

    rare = (byte(size) * 31 + F.when(size > 1, byte(size - 1)).otherwise(0) * 17) % RARE_CLASSES
    sums = counts.groupBy(rare.alias("g")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).toPandas()
    n, distinct = np.zeros(RARE_CLASSES, dtype=np.int64), np.zeros(RARE_CLASSES, dtype=np.int64)
    n[sums["g"]], distinct[sums["g"]] = sums["n"], sums["words"]
    total = int(n.sum()), int(distinct.sum())
    for word, count in zip(words[:SOFTMAX_WORDS], top["n"]):
        n[rare_class(word)] -= count
        distinct[rare_class(word)] -= 1
    return Vocabulary(words, top["n"].to_numpy(dtype=np.int64), *total, n, distinct)


# ---- the model -------------------------------------------------------------------------


class Weights(NamedTuple):
    classes: np.ndarray  # CLASS_ROWS x classes
    members: np.ndarray  # WORD_ROWS x CLASS_WORDS
    class_steps: np.ndarray  # AdaGrad's sum of squares of each row
    member_steps: np.ndarray

    @classmethod
    def new(cls, vocab: Vocabulary) -> Weights:
        return cls(np.zeros((CLASS_ROWS, vocab.classes), dtype=np.float32), np.zeros((WORD_ROWS, CLASS_WORDS), dtype=np.float32),
                   np.full(CLASS_ROWS, 1e-6, dtype=np.float32), np.full(WORD_ROWS, 1e-6, dtype=np.float32))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _U(0x9E3779B97F4A7C15)
    h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


@lru_cache(maxsize=4)
def _mixed(symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Mixes of all symbols, one row a feature, and of all classes (fewer than symbols)."""
    each = np.arange(symbols, dtype=np.uint64)
    return np.stack([_mix(each + _U(1) + _U(j << 40)) for j in range(5)]), _mix(each + _U(5 << 40))


def rows_of(history: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class rows, member rows), one column a feature, of tokens with the symbols
    ``history`` (one before, two before, three before) and the classes ``own``."""
    mixed, classes = _mixed(SOFTMAX_WORDS + RARE_CLASSES + 1)
    one, two, three = (history[:, j] for j in range(3))
    pair = mixed[0].take(one) + (two.astype(np.uint64) + _U(1)) * _U(0x2545F4914F6CDD1D)
    grams = [mixed[1].take(one), _mix(pair + _U(2 << 40)), mixed[3].take(two), mixed[4].take(three)]
    in_class = classes.take(own)
    return (np.stack([g & _U(CLASS_ROWS - 1) for g in grams], axis=1).astype(np.int64),
            np.stack([_mix(g + in_class) & _U(WORD_ROWS - 1) for g in grams[:3]], axis=1).astype(np.int64))


def _exponentials(table: np.ndarray, rows: np.ndarray, bias: np.ndarray, place: np.ndarray | None = None,
                  normal: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(exponentials of the sums of ``table``'s ``rows`` and of ``bias``, or its row
    ``place``, and their sums by row); ``normal``: divided by these. Logits beyond LIMIT stop
    there, where single precision would soon end."""
    n, width = len(rows), table.shape[1]
    out, total = np.empty((n, width), dtype=np.float32), np.empty(n, dtype=np.float32)
    more, ones, columns = np.empty((NEAR, width), dtype=np.float32), np.ones(width, dtype=np.float32), np.ascontiguousarray(rows.T)
    for at in range(0, n, NEAR):
        logits = out[at:at + NEAR]
        part = more[:len(logits)]
        table.take(columns[0, at:at + NEAR], axis=0, out=logits, mode="clip")  # in place only with a mode
        for own in columns[1:]:
            logits += table.take(own[at:at + NEAR], axis=0, out=part, mode="clip")
        logits += bias if place is None else bias.take(place[at:at + NEAR], axis=0, out=part, mode="clip")
        np.clip(logits, -LIMIT, LIMIT, out=logits)
        np.exp(logits, out=logits)
        np.matmul(logits, ones, out=total[at:at + NEAR])
        if normal:
            logits /= total[at:at + NEAR, None]
    return out, total


class Model:
    """A vocabulary and weights, as tasks use them; without ``places`` rare words have none,
    and their symbols only."""

    def __init__(self, vocab: Vocabulary, weights: Weights, places: bool = True):
        self.vocab, self.weights, self.places = vocab, weights, places
        # Apart, as most tokens are among the few first, which stay in a core's cache.
        self.first = {w: i for i, w in enumerate(vocab.words[:SOFTMAX_WORDS])}
        self.others = {w: i for i, w in enumerate(vocab.words[SOFTMAX_WORDS:], SOFTMAX_WORDS)} if places else {}
        self.class_bias, self.member_bias = vocab.biases()
        self.heads = vocab.softmax_classes
        self.start = SOFTMAX_WORDS + RARE_CLASSES  # the symbol before a text
        self.log_counts = np.append(np.log10(vocab.counts + 1.0), 0.0)  # place -1: no count

    def symbols(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(place in the table or -1, symbol): a softmax word's place, else its rare class."""
        place = np.fromiter(map(self.first.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        symbol, rare = place.copy(), np.flatnonzero(place < 0)
        if len(rare):
            found = [words[i] for i in rare.tolist()]
            symbol[rare] = SOFTMAX_WORDS + rare_classes(found)
            if self.places:
                place[rare] = np.fromiter(map(self.others.get, found, repeat(-1)), dtype=np.int64, count=len(found))
        return place, symbol

    def targets(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(class, member or -1)."""
        rare = symbol >= SOFTMAX_WORDS
        return (np.where(rare, symbol - SOFTMAX_WORDS + self.heads, symbol // CLASS_WORDS),
                np.where(rare, -1, symbol % CLASS_WORDS))

    def exponentials(self, own: np.ndarray, classes: np.ndarray, members: np.ndarray, normal: bool = False):
        """(of all classes, their sums; the tokens of softmax words; for these, of all
        members of their class, their sums) by rows of weights."""
        p, total = _exponentials(self.weights.classes, classes, self.class_bias, normal=normal)
        head = np.flatnonzero(own < self.heads)
        if not len(head):
            return p, total, head, np.zeros((0, CLASS_WORDS), dtype=np.float32), np.zeros(0, dtype=np.float32)
        return p, total, head, *_exponentials(self.weights.members, members[head], self.member_bias, own[head], normal)

    def log10(self, history: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """log10 P(class | history), and of softmax words times P(word | class, history)."""
        out = np.empty(len(symbol))
        for at in range(0, len(symbol), SCORED):
            own, member = self.targets(symbol[at:at + SCORED])
            past = history[at:at + SCORED]
            p, total, head, q, inner = self.exponentials(own, *rows_of(past, own))
            part = np.log10(p[np.arange(len(own)), own].astype(np.float64) / total)
            part[head] += np.log10(q[np.arange(len(head)), member[head]].astype(np.float64) / inner)
            out[at:at + SCORED] = part
        return out

    def update(self, history: np.ndarray, symbol: np.ndarray) -> None:
        """One AdaGrad step on these tokens."""
        own, member = self.targets(symbol)
        classes, members = rows_of(history, own)
        p, _, head, q, _ = self.exponentials(own, classes, members, normal=True)
        p[np.arange(len(own)), own] -= 1
        q[np.arange(len(head)), member[head]] -= 1
        _step(self.weights.classes, self.weights.class_steps, classes, p)
        _step(self.weights.members, self.weights.member_steps, members[head], q)


def _row_sums(gradient: np.ndarray, source: np.ndarray, first: np.ndarray, n: np.ndarray, total: np.ndarray, more: np.ndarray) -> None:
    """Sums of ``gradient`` over segments of ``source``, which start at ``first`` and have ``n``
    entries, most first, into ``total``: short segments together, entry by entry, long ones
    each by itself."""
    gradient.take(source[first], axis=0, out=total, mode="clip")
    long = int(np.searchsorted(-n, -SHORT))
    for k in range(1, int(n[long]) if long < len(n) else 1):
        upto = int(np.searchsorted(-n, -k))
        total[long:upto] += gradient.take(source[first[long:upto] + k], axis=0, out=more[:upto - long], mode="clip")
    for i in range(long):
        total[i] = gradient.take(source[first[i]:first[i] + n[i]], axis=0).sum(axis=0)


def _step(table: np.ndarray, steps: np.ndarray, rows: np.ndarray, gradient: np.ndarray) -> None:
    if not len(rows):
        return
    flat = rows.ravel()
    order = np.argsort(flat.astype(np.uint16), kind="stable")  # there are fewer rows than 1 << 16
    own, source = flat[order], order // rows.shape[1]
    first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
    n = np.diff(np.append(first, len(own)))
    by_size = np.argsort(-n, kind="stable")
    first, n = first[by_size], n[by_size]
    room = np.empty((2, NEAR, table.shape[1]), dtype=table.dtype)
    for at in range(0, len(first), NEAR):
        touched = own[first[at:at + NEAR]]
        total, more = room[:, :len(touched)]
        _row_sums(gradient, source, first[at:at + NEAR], n[at:at + NEAR], total, more)
        steps[touched] += np.einsum("ij,ij->i", total, total)
        total *= (-STEP / np.sqrt(steps[touched]))[:, None]
        total += table.take(touched, axis=0, out=more, mode="clip")
        table[touched] = total


def with_history(symbols: np.ndarray, past: np.ndarray, starts: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """(history of each symbol, the last three symbols), after the three in ``past``; texts
    begin at ``starts``, and what was before them is ``start``."""
    line = np.concatenate((past, symbols))
    n = len(symbols)
    history = np.stack([line[2:2 + n], line[1:1 + n], line[:n]], axis=1)
    for k in range(3):
        history[starts[starts + k < n] + k, k:] = start
    last = line[-3:].copy()
    if len(starts):
        last[:max(0, 3 - (n - int(starts[-1])))] = start
    return history, last


def pieces(model: Model, texts: Iterator[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[tuple[int, list[bytes]]]]]:
    """(number of the text, places, symbols, histories of the tokens, and for each text the
    words outside the table, with its number) of about PIECE tokens each."""
    words: list[bytes] = []
    parts: list[tuple[int, int]] = []  # (number of the text, where its part of the words begins)
    starts: list[int] = []
    past = np.full(3, model.start)

    def piece():
        nonlocal past
        place, symbol = model.symbols(words)
        history, past = with_history(symbol, past, np.array(starts, dtype=np.int64), model.start)
        of, begin = (np.array(x, dtype=np.int64) for x in zip(*parts))
        outside = np.flatnonzero(place < 0) if model.places else begin[:0]
        unknown = [words[j] for j in outside.tolist()]
        cuts = [*np.searchsorted(outside, begin).tolist(), len(outside)]
        return (np.repeat(of, np.diff(np.append(begin, len(words)))), place, symbol, history,
                [(i, unknown[a:b]) for (i, _), a, b in zip(parts, cuts, cuts[1:])])

    for i, text in enumerate(texts):
        starts.append(len(words))
        for part in tokens(text):
            parts.append((i, len(words)))
            words += part
            if len(words) >= PIECE:
                yield piece()
                words, parts, starts = [], [], []
    if words:
        yield piece()


# ---- training --------------------------------------------------------------------------


class Trained(NamedTuple):
    vocab: Vocabulary
    weights: Weights
    counts: DataFrame  # (word, n), as a written table


def _learner(vocab: Vocabulary, weights: Weights):
    """Minibatch updates over a task's texts, and then the blocks of rows it touched."""

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Weights(*(x.copy() for x in weights))
        model = Model(vocab, own, places=False)
        symbols, history = np.empty(0, dtype=np.int64), np.empty((0, 3), dtype=np.int64)
        for batch in batches:
            for _, _, symbol, past, _ in pieces(model, batch["text"]):
                symbols, history = np.concatenate((symbols, symbol)), np.concatenate((history, past))
                whole = len(symbols) // BATCH * BATCH
                for at in range(0, whole, BATCH):
                    model.update(history[at:at + BATCH], symbols[at:at + BATCH])
                symbols, history = symbols[whole:], history[whole:]
        if len(symbols):
            model.update(history, symbols)
        rows = []
        for part in (0, 1):
            moved = own[part + 2] - weights[part + 2]
            change = (own[part] - weights[part]).astype(np.float16)  # half of what is sent
            for block in np.unique(np.flatnonzero(moved) // BLOCK):
                at = slice(block * BLOCK, (block + 1) * BLOCK)
                rows.append((part, int(block), change[at].tobytes(), moved[at].tobytes()))
        yield pd.DataFrame(rows, columns=["part", "block", "change", "moved"])

    return learn


def _sum_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The blocks' sums over all tasks; it holds one copy of each block at a time."""
    sums: dict[tuple[int, int], list[np.ndarray]] = {}
    for batch in batches:
        for b in batch.itertuples():
            moved = np.frombuffer(b.moved, dtype=np.float32)
            change = np.frombuffer(b.change, dtype=np.float16).reshape(len(moved), -1) * moved[:, None]
            own = [change, moved]
            seen = sums.get((b.part, b.block))
            sums[b.part, b.block] = [x + y for x, y in zip(seen, own)] if seen else own
    rows = [(*key, *(x.tobytes() for x in total)) for key, total in sums.items()]
    yield pd.DataFrame(rows, columns=["part", "block", "change", "moved"])


def train(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", rounds: int = ROUNDS) -> Trained:
    """Counts and weights learned from all rows of ``docs``."""
    texts = docs.select(F.col(text).cast("binary").alias("text"),
                        F.pmod(F.xxhash64(F.lit(13), doc_id, text), F.lit(rounds)).alias("round"))
    counts = materialised(word_counts(texts.select("text")), "words")
    vocab = vocabulary(counts)
    weights = Weights.new(vocab)
    tasks = max(1, round(vocab.train_tokens / rounds / SHARD_TOKENS))
    schema = "part int, block int, change binary, moved binary"
    for r in range(rounds):
        rows = texts.filter(F.col("round") == r).select("text").coalesce(tasks)
        blocks = rows.mapInPandas(_learner(vocab, weights), schema)
        # As many rows as the tables have blocks reach the driver, whatever the corpus.
        for b in blocks.repartition("part", "block").mapInPandas(_sum_blocks, schema).toPandas().itertuples():
            at = slice(b.block * BLOCK, (b.block + 1) * BLOCK)
            moved = np.frombuffer(b.moved, dtype=np.float32)
            change = np.frombuffer(b.change, dtype=np.float32).reshape(len(moved), -1)
            weights[b.part][at] += change / np.where(moved > 0, moved, 1)[:, None]
            weights[b.part + 2][at] += moved
    return Trained(vocab, weights, counts)


# ---- scores ----------------------------------------------------------------------------

SCORES = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
_PART = "n_tokens long, n_known long, table_log double, part double, rest string"


def _scorer(vocab: Vocabulary, weights: Weights):
    @F.pandas_udf(_PART)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Model(vocab, weights)
        shares = np.log10(vocab.rare_tokens + vocab.rare_words + 1.0)
        for texts in batches:
            n = len(texts)
            sums = np.zeros((4, n))
            rest = [b""] * n
            for text, place, symbol, history, unknown in pieces(model, texts):
                log = model.log10(history, symbol)
                known, rare = place >= 0, symbol >= SOFTMAX_WORDS
                counted = model.log_counts[place]
                log[rare] += counted[rare] - shares[symbol[rare] - SOFTMAX_WORDS]
                for k, x in enumerate((np.ones(len(text)), known, counted, log)):
                    sums[k] += np.bincount(text, weights=x, minlength=n)
                for i, words in unknown:
                    if words:
                        rest[i] = b" ".join([rest[i], *words]) if rest[i] else b" ".join(words)
            yield pd.DataFrame({"n_tokens": sums[0].astype(np.int64), "n_known": sums[1].astype(np.int64), "table_log": sums[2],
                                "part": sums[3], "rest": [r.decode() for r in rest]})

    return score


def score(docs: DataFrame, trained: Trained, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``'s columns (but those named like a new one) with n_tokens, n_known (of
    training words), train_tokens, base_score (add-one unigram) and score (the model), both
    log10 probabilities."""
    vocab = trained.vocab
    keep = tuple(c for c in keep if c not in SCORES)
    # The names of the columns kept may be any, so they stay apart until the end.
    parts = docs.select(F.struct(*keep).alias("kept"), _scorer(vocab, trained.weights)(F.col(text).cast("binary")).alias("p"))
    parts = materialised(parts.select(F.monotonically_increasing_id().alias("row"), "kept", "p.*"), "parts")
    # The words outside the table, one row each; no word holds a blank.
    words = F.explode(F.split(F.col("rest"), " ").cast("array<binary>")).alias("word")
    met = parts.filter(F.col("rest") != "").select("row", words).join(trained.counts, "word")
    found = met.groupBy("row").agg(F.count(F.lit(1)).alias("met"), F.sum(F.log10(F.col("n") + 1.0)).alias("log"))
    log = F.coalesce("log", F.lit(0.0))
    base = F.col("table_log") + log - F.col("n_tokens") * F.lit(float(np.log10(vocab.train_tokens + vocab.train_words + 1)))
    return parts.drop("rest").join(found, "row", "left").select(
        *[F.col("kept")[c].alias(c) for c in keep], "n_tokens", (F.col("n_known") + F.coalesce("met", F.lit(0))).alias("n_known"),
        F.lit(vocab.train_tokens).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("part") + log).alias("score"))
