"""Secret scanning with DataFrame functions only: patterns find candidates, and a random
forest, trained from labelled findings, takes out the false positives.

Candidates are keys of well-known forms (a PEM key from its BEGIN to its END line),
passwords in URLs, Bearer values, values assigned to names that contain a word such as
``password`` or ``token`` (DB_PASSWORD_PROD), and mixed strings of 20 or more characters.
What has none of these forms, such as a short value that nothing names, is no candidate; of
a PEM key without its END line only the BEGIN line and mixed strings are. A candidate's features are its length and character
make-up, its character transitions, how much of it dictionary words cover, whether it lies
in a path or the document's path looks like a test's, and its neighbouring words.

Spark's ``RandomForestClassifier`` is trained on a bounded set of labelled findings; its
trees become literal arrays that a fold walks in place. So a scan is one narrow pass over
the whole texts: no candidate is shuffled, however many a document has.

Labelled findings may be given (``train(findings)``). Without them ``labelled_findings``
makes some: into the beginnings of a bounded number of documents it puts generated values
of known kind, real-looking ones (label 1) and placeholders, digests, ids, paths and words
(label 0), and scans the result like any document.

Defined cases: null text has no candidate and stays null; a null path is ``""``; a finding
is reported where it stands, so repeated values and rows are reported each time; an empty
table gives no rows; other columns are kept, but for ``findings``, which is replaced.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.common import let, materialised

CONTEXTS = 250
CONTEXT_CHARS = 400
TREES, DEPTH = 24, 7
THRESHOLD = 0.5
MASK = "[SECRET]"

# Patterns of candidates.
NAMES = r"(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth[_-]?key|private[_-]?key|credential)s?"
IS = r"[\"']?[ \t]{0,3}(?:=>|:=|[:=])"
# A whole word that contains a name, or a name at a word's end where a match before took the word's start. What
# follows the word is looked at first: few words are searched for names.
WORD = r"[0-9A-Za-z_.-]"
NAMED = rf"(?:(?<!{WORD})(?={WORD}++{IS})(?={WORD}*?(?i:{NAMES})){WORD}++|(?=[AaCcPpSsTt])(?i:{NAMES}))"
HEAD = rf"{NAMED}{IS}[ \t]{{0,3}}[\"']?"
URL_HEAD = r"://[^\s/?#:@\"'`<>]*+:"
IN_URL = r"[^\s/?#\"'`<>]+(?=@)"
BEARER_HEAD = r"(?<![0-9A-Za-z])[Bb](?i:earer)[ \t]{1,3}"
BEARER = r"[0-9A-Za-z._~+/=-]{6,}+"
BEGIN = r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"
KEYS = "|".join((
    r"(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])",
    r"gh[pousr]_[0-9A-Za-z]{36}(?![0-9A-Za-z])",
    r"xox[abprs]-[0-9A-Za-z-]{10,}+",
    r"AIza[0-9A-Za-z_-]{35}(?![0-9A-Za-z_-])",
    r"sk_(?:live|test)_[0-9A-Za-z]{16,}+",
    r"eyJ[0-9A-Za-z_-]{8,}+\.[0-9A-Za-z_-]{8,}+\.[0-9A-Za-z_-]{8,}+",
    r"SG\.[0-9A-Za-z_-]{16,}+\.[0-9A-Za-z_-]{16,}+",
))
KNOWN = "|".join((
    rf"(?=[ASagsxe])(?<![0-9A-Za-z])(?:{KEYS})",
    # From BEGIN to the next five dashes, if they are those of END.
    BEGIN + r"(?:(?>[\s\S]*?-----)END [A-Z ]{0,30}PRIVATE KEY-----)?",
))
# Not the value, but what stands in it, where that is a URL with a password, "Bearer ..." or a PEM key.
ASSIGNED = rf"{HEAD}(?![A-Za-z][0-9A-Za-z+.-]*+{URL_HEAD}{IN_URL}|(?i:bearer)[ \t]{{1,3}}{BEARER}|{BEGIN})[^\s\"'`,;<>(){{}}]{{6,}}+"
HEADED = rf"{URL_HEAD}{IN_URL}|{BEARER_HEAD}(?!{KNOWN}|{HEAD}){BEARER}"
MIXED = r"(?<![0-9A-Za-z+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[0-9A-Za-z+/_=-]{20,}+"
CANDIDATE = f"{KNOWN}|{ASSIGNED}|{HEADED}|{MIXED}"

# Dictionary words, frequent pairs of letters, and words beside a finding.
WORDS = (
    "account|access|admin|api|auth|base|bearer|build|cache|change|class|client|code|commit|config|connection|data|default|"
    "demo|domain|dummy|email|enter|error|example|false|field|file|fixture|function|global|hash|header|here|home|host|http|"
    "id|index|input|insert|invalid|item|key|lib|local|login|main|me|method|missing|mock|module|my|name|none|null|number|"
    "object|option|output|package|param|pass|password|path|placeholder|port|private|public|query|readme|replace|request|"
    "required|response|return|sample|secret|select|server|service|session|site|source|string|system|table|temp|test|text|"
    "this|time|title|todo|token|true|type|update|user|usr|value|version|view|with|word|xxx|your"
)
LETTER_PAIRS = (
    "th|he|in|er|an|re|on|at|en|nd|ti|es|or|te|of|ed|is|it|al|ar|st|to|nt|ng|se|ha|as|ou|io|le|ve|co|me|de|hi|ri|ro|ic|ne|"
    "ea|ra|ce|li|ch|ll|be|ma|si|om|ur|ue|qu|ie|un|sch|ei|os|la|el|do|ci"
)
BESIDE_SECRETS = r"password|passwd|pwd|secret|token|api|key|credential|auth|aws|login|bearer"
BESIDE_OTHERS = r"example|sample|dummy|test|placeholder|sha|commit|digest|hash|checksum|uuid|version|revision|etag|integrity|blob"
TEST_PATH = r"test|example|fixture|sample|mock|docs?/|spec"

FEATURES = (
    "length", "runs", "digits", "upper", "hex", "distinct", "pairs", "covered", "near_secret", "near_other", "in_path",
    "test_path", "assigned", "known",
)


def _split_match(match: Column) -> Column:
    """(head, value): what comes before the secret itself and the secret. A key of known
    form has no head; an assignment's head is the name up to the assigned value, a URL's
    reaches from :// to the password, and a Bearer value's is that word."""
    head = F.regexp_extract(match, f"^(?!{KNOWN})({HEAD}|{URL_HEAD}|{BEARER_HEAD})", 1)
    return let(head, lambda h: F.struct(h.alias("head"), F.substring(match, F.length(h) + 1, F.length(match)).alias("value")))


def _share(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.greatest(whole, F.lit(1)).cast("double")


def _flag(c: Column) -> Column:
    return F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))


def _of_value(value: Column) -> list[Column]:
    n, lower = F.length(value), F.lower(value)

    def count(chars: str) -> Column:
        return n - F.length(F.regexp_replace(value, f"[{chars}]", ""))

    runs = value
    for chars, one in (("a-z", "a"), ("A-Z", "A"), ("0-9", "0")):
        runs = F.regexp_replace(runs, f"[{chars}]+", one)
    start = F.left(value, F.lit(200))
    return [
        F.least(n, F.lit(200)).cast("double"),
        _share(F.length(runs) - 1, n - 1), _share(count("0-9"), n), _share(count("A-Z"), n), _share(count("0-9a-f"), n),
        _share(F.size(F.array_distinct(F.split(start, ""))), F.length(start)),
        _share(F.regexp_count(lower, F.lit(f"(?={LETTER_PAIRS})")), n - 1),
        _share(n - F.length(F.regexp_replace(lower, WORDS, "")), n),
    ]


def _features(match: Column, parts: Column, before: Column, after: Column, path: Column) -> Column:
    # The words before, the name that a value is assigned to, and the word after.
    near = F.lower(F.concat_ws(" ", F.right(before, F.lit(40)), parts["head"], F.left(after, F.lit(20))))
    in_path = parts["value"].rlike(r"^[\w.-]*(?:/[\w.-]{2,}){2,}/?$") | F.right(before, F.lit(1)).isin("/", "\\")
    around = let(near, lambda x: F.array(_flag(x.rlike(BESIDE_SECRETS)), _flag(x.rlike(BESIDE_OTHERS))))
    return F.concat(
        let(parts["value"], lambda v: F.array(*_of_value(v))), around,
        F.array(_flag(in_path), _flag(F.lower(path).rlike(TEST_PATH)), _flag(parts["head"] != ""), _flag(match.rlike(f"^(?:{KNOWN})"))))


def _candidates(path: Column) -> Column:
    """Array of (start from 0, head, value, features) of all candidates, in order, from the
    columns __m and __g of ``with_candidates``. A candidate's start is a running sum over
    the lengths of what comes before it."""
    kind = "array<int>"
    starts = F.aggregate(
        F.sequence(F.lit(0), F.size("__m") - 1), F.array().cast(kind),
        lambda acc, i: F.array_append(acc, F.coalesce(F.try_element_at(acc, F.lit(-1)) + F.length(F.get("__m", i - 1)), F.lit(0))
                                      + F.length(F.get("__g", i))))

    def one(match: Column, i: Column, start: Column) -> Column:
        return let(_split_match(match), lambda p: F.struct(
            start.alias("start"), p["head"].alias("head"), p["value"].alias("value"),
            _features(match, p, F.get("__g", i), F.get("__g", i + 1), path).alias("features")))

    return let(starts, lambda s: F.transform("__m", lambda match, i: one(match, i, F.get(s, i))))


@dataclass(frozen=True)
class Forest:
    """Trees as parallel arrays: of node i the feature, the threshold, the node to go to if
    the feature is at most that, the node to go to if not (-1: a leaf), and the leaf's class."""

    trees: tuple[tuple[tuple[int, float, int, int, float], ...], ...]

    def score(self, x: Column) -> Column:
        """The share of the trees that vote for a secret."""
        one = "array<struct<f: int, t: double, l: int, r: int, v: double>>"
        rows = [[{"f": f, "t": t, "l": low, "r": high, "v": v} for f, t, low, high, v in tree] for tree in self.trees]
        trees = F.from_json(F.lit(json.dumps(rows)), f"array<{one}>")
        steps = F.sequence(F.lit(1), F.lit(DEPTH))

        def vote(tree: Column) -> Column:
            def step(node: Column, _: Column) -> Column:
                at = F.get(tree, node)
                return F.when(at["l"] < 0, node).when(F.get(x, at["f"]) <= at["t"], at["l"]).otherwise(at["r"])

            return F.get(tree, F.aggregate(steps, F.lit(0), step))["v"]

        return F.aggregate(trees, F.lit(0.0), lambda total, tree: total + vote(tree)) / float(len(self.trees))


def read_tree(described: str) -> tuple[tuple[int, float, int, int, float], ...]:
    """A tree from the lines in which Spark describes it."""
    lines = iter([x.strip() for x in described.splitlines()[1:] if x.strip()])
    nodes: list[tuple[int, float, int, int, float]] = []

    def read() -> int:
        line, own = next(lines), len(nodes)
        nodes.append((0, 0.0, -1, -1, 0.0))
        if line.startswith("Predict:"):
            nodes[own] = (0, 0.0, -1, -1, float(line.split(":")[1]))
            return own
        feature, threshold = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        low = read()
        next(lines)  # Else (...)
        nodes[own] = (int(feature), float(threshold), low, read(), 0.0)
        return own

    read()
    return tuple(nodes)


def train(findings: DataFrame, seed: int = 7) -> Forest:
    """A forest from labelled findings: features array<double> and label 0 or 1."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    rows = findings.select(array_to_vector("features").alias("features"), F.col("label").cast("double").alias("label"))
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="onethird").fit(rows)
    return Forest(tuple(read_tree(t.toDebugString) for t in model.trees))


def _planted() -> list[tuple[int, Column, Column]]:
    """(label, text, path) of each kind of generated finding. ``h1`` and ``h2`` are hex
    digests, ``b`` is base 62, ``w1`` to ``w3`` are words of the dictionary and ``said`` is
    a word of the document."""
    h1, h2, b, w1, w2, w3, said = (F.col(c) for c in ("h1", "h2", "b", "w1", "w2", "w3", "said"))
    none, test = F.lit("src/app/settings"), F.lit("tests/fixtures/data")

    def text(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    def first(c: Column, n: int) -> Column:
        return F.left(c, F.lit(n))

    return [
        (1, text("AKIA", first(F.upper(b), 16)), none),
        (1, text("password=", first(h1, 18)), none),
        (1, text('token = "', first(h1, 40), '"'), none),
        (1, text("api_key: '", first(b, 32), "'"), none),
        (1, text("ghp_", first(b, 36)), none),
        (1, text("secret=", first(b, 40)), none),
        (1, text("the aws secret key ", first(b, 40)), none),
        (1, text("sk_live_", first(b, 24)), none),
        (1, text('pwd: "', first(b, 14), '"'), none),
        (0, text("password=", w1, "_", w2), none),
        (0, text('token = "your_', w1, "_", w2, '_here"'), none),
        (0, text("AKIA", first(F.upper(b), 9), "EXAMPLE"), none),
        (0, text("commit ", first(h1, 40)), none),
        (0, text("sha256 digest ", h2), none),
        (0, text("uuid ", first(h1, 8), "-", first(h2, 4), "-4", F.substring(h1, 9, 3), "-a", F.substring(h2, 5, 3), "-",
                 F.substring(h1, 12, 12)), none),
        (0, text("/usr/lib/", w1, "/", w2, "3/", w3, "_module/", w1), none),
        (0, text(F.initcap(w1), F.initcap(w2), F.initcap(w3), "Handler2Factory", F.initcap(w2)), none),
        (0, text("secret: ", w1, w2), none),
        (0, text("password=", first(h1, 18)), test),
        (0, text("api_key: example_", w1, "_", first(h1, 4)), none),
        # Names within longer ones.
        (1, text('SECRET_KEY = "', first(h1, 12), '"'), none),
        (0, text('SECRET_KEY = "your-', w1, "-", w2, '"'), none),
        (1, text('DB_PASSWORD_PROD: "', F.lower(first(b, 6)), first(F.translate(h1, "abcdef", "012345"), 4), '"'), none),
        (0, text('DB_PASSWORD_PROD: "', w1, "_", w2, '"'), none),
        (0, text("the ", w1, "_secretary_", w2, ": ", w3, "_", w1), none),
        (0, text("the secretary: ", said), none),
        (0, text("token: ", said), none),
        # Passwords in URLs.
        (1, text("postgres://", w1, ":", first(b, 10), "@db.", w2, "/", w3), none),
        (1, text("https://", w1, ":", first(b, 32), "@", w2, ".com/", w3), none),
        (0, text("postgres://", w1, ":", w2, "@db.", w3, "/", w1), none),
        (0, text("redis://:${", F.upper(w1), "_", F.upper(w2), "}@", w3, ":6379"), none),
        # Bearer values.
        (1, text("Authorization: Bearer ", F.translate(first(b, 32), "0123456789", "qRsTuVwXyZ")), none),
        (1, text("Authorization: Bearer ", first(b, 20), ".", first(h1, 24)), none),
        (0, text("Authorization: Bearer your_", w1, "_", w2), none),
        (0, text("the bearer ", said), none),
        # Keys with dots, and long strings behind a dot.
        (1, text("SG.", first(b, 22), ".", first(h1, 11), F.substring(b, 11, 32)), none),
        (0, text("SG.your_", w1, "_", w2, "_api_key.your_", w1, "_", w3, "_sendgrid_secret"), none),
        (1, text("the token hvs.", first(b, 40)), none),
        (0, text("org.", w1, ".", w2, "_", w3, "2_module_handler_", w1), none),
        (0, text("0.", first(F.translate(h1, "abcdef", "012345"), 24)), none),
        # PEM keys.
        (1, text("-----BEGIN PRIVATE KEY-----\n", b, h1, "\n", h2, b, "==\n-----END PRIVATE KEY-----"), none),
        (1, text("-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,", F.upper(first(h1, 32)),
                 "\n\n", b, h2, "\n", b, "\n-----END RSA PRIVATE KEY-----"), none),
        (0, text("-----BEGIN RSA PRIVATE KEY-----\nyour ", w1, " ", w2, " here\n-----END RSA PRIVATE KEY-----"), none),
    ]


def labelled_findings(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", contexts: int = CONTEXTS) -> DataFrame:
    """(features, label) of generated findings in the beginnings of the ``contexts`` rows
    with the smallest hash of their id, and once in no text at all."""
    spark = docs.sparkSession
    start = docs.select(F.xxhash64(F.lit(3), F.col(doc_id)).alias("id"),
                        F.left(F.coalesce(F.col(text), F.lit("")), F.lit(CONTEXT_CHARS)).alias("context"))
    start = start.orderBy("id", "context").limit(contexts)
    start = start.union(spark.range(1).select("id", F.lit("").alias("context")))
    kinds = _planted()
    rows = start.withColumn("kind", F.explode(F.sequence(F.lit(0), F.lit(len(kinds) - 1))))
    words = F.split(F.lit(WORDS), r"\|")

    def digest(salt: str) -> Column:
        return F.sha2(F.concat_ws(":", F.col("id").cast("string"), F.col("kind").cast("string"), F.lit(salt)), 256)

    def word(i: int) -> Column:
        return F.get(words, F.pmod(F.xxhash64(F.lit(i), "id", "kind"), F.size(words)).cast("int"))

    rows = rows.withColumns({
        "h1": digest("1"), "h2": digest("2"), "b": F.translate(F.base64(F.unhex(digest("3"))), "+/=", "x7"),
        "w1": word(1), "w2": word(2), "w3": word(3)})
    said = F.regexp_extract("context", r"\b([a-z]{6,12})\b", 1)
    rows = rows.withColumn("said", F.when(said == "", F.concat("w1", "w2")).otherwise(said))

    def by_kind(pick) -> Column:
        return F.get(F.array(*[pick(k) for k in kinds]), F.col("kind"))

    # Between two words of the text, at its middle.
    half = F.regexp_extract("context", r"(?s)^(.{0,200}\s)?", 1)
    rows = rows.withColumns({"half": half, "planted": by_kind(lambda k: k[1])})
    planted = materialised(rows.select(
        by_kind(lambda k: F.lit(k[0])).alias("label"), by_kind(lambda k: k[2]).alias("path"), F.length("half").alias("at"), "planted",
        F.concat("half", "planted", F.lit(" "), F.substring("context", F.length("half") + 1, F.lit(CONTEXT_CHARS))).alias("text")),
        "planted")
    found = with_candidates(planted, "text", F.col("path")).select("label", "at", "planted", F.explode_outer("__c").alias("c"))
    end = F.col("c.start") + F.length("c.head") + F.length("c.value")
    inside = (F.col("c.start") >= F.col("at")) & (end <= F.col("at") + F.length("planted"))
    # One small file in one order: the forest's bootstrap samples are the same on every run.
    chosen = found.filter(inside).select("label", "c.features").repartition(1).sortWithinPartitions("label", "features")
    return materialised(chosen, "findings")


def with_candidates(docs: DataFrame, text: str, path: Column) -> DataFrame:
    """``docs`` with __m (matches), __g (the text between them, one more) and __c
    (candidates). Explode __c with ``explode_outer``: a plain explode makes the optimiser
    compute it once more, for a filter."""
    none = F.array().cast("array<string>")
    has = F.coalesce(F.col(text).rlike(CANDIDATE), F.lit(False))
    split = docs.withColumn("__has", has).withColumns({
        "__m": F.when(F.col("__has"), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))).otherwise(none),
        "__g": F.when(F.col("__has"), F.split(text, CANDIDATE, -1)).otherwise(none)}).drop("__has")
    kind = "array<struct<start: int, head: string, value: string, features: array<double>>>"
    return split.withColumn("__c", F.when(F.size("__m") > 0, _candidates(path)).otherwise(F.array().cast(kind)))


def scan(docs: DataFrame, forest: Forest, *, text: str = "text", path: str | None = None, threshold: float = THRESHOLD,
         redact: bool = False) -> DataFrame:
    """``docs`` with ``findings``, an array of (start, value, score, is_secret), the start
    from 0 in code points of the text. With ``redact``, secrets in ``text`` become MASK."""
    where = F.coalesce(F.col(path).cast("string"), F.lit("")) if path else F.lit("")

    def finding(c: Column) -> Column:
        return let(forest.score(c["features"]), lambda score: F.struct(
            (c["start"] + F.length(c["head"])).alias("start"), c["value"].alias("value"), score.alias("score"),
            (score >= threshold).alias("is_secret")))

    out = with_candidates(docs, text, where).withColumn("findings", F.transform("__c", finding))
    if redact:
        kept = F.zip_with("__m", "findings", lambda m, f: F.when(
            f["is_secret"], F.concat(F.left(m, F.length(m) - F.length(f["value"])), F.lit(MASK))).otherwise(m))
        clean = F.array_join(F.zip_with("__g", kept, lambda g, m: F.concat(g, F.coalesce(m, F.lit("")))), "")
        out = out.withColumn(text, F.when(F.exists("findings", lambda f: f["is_secret"]), clean).otherwise(F.col(text)))
    return out.drop("__m", "__g", "__c")


def forest_for(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> Forest:
    return train(labelled_findings(docs, doc_id=doc_id, text=text))
