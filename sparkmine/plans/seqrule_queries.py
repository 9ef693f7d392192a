"""Registered sequential-rule queries over the (user, day) event sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmine.operators import postings as P
from sparkmine.operators import seqrules as SR
from sparkmine.plans import views as V
from sparkmine.plans.catalog import register
from sparkmine.plans.oracle_views import with_views as W

# Fixed thresholds for the sequence fixture (see FIXTURES.md section 4).
MIN_SUPPORT = 0.0215
MIN_CONFIDENCE = 0.1
BIN_INTERVAL = 0.05


def _flat(df):
    return df.select(F.array_join("antecedent", ",").alias("antecedent"),
                     F.array_join("consequent", ",").alias("consequent"),
                     F.col("support").cast("bigint").alias("support"), "support_rel", "confidence")


def _mine(spark, d, max_a, max_c):
    return SR.sequential_rules(V.sequences(spark, d), MIN_SUPPORT, MIN_CONFIDENCE, max_a, max_c)


# Heavier benchmark: (user, week) sequences over 20 items, rules up to 2 => 2.
WEEKLY_MIN_SUPPORT = 0.05
WEEKLY_MIN_CONFIDENCE = 0.1
RARE_SUPPORT = 0.025


def _base(view: str = "sequences", min_support: float = MIN_SUPPORT) -> list[tuple[str, str]]:
    return [
        ("nseq", f"select count(distinct seq_id) as n from {view}"),
        ("mc", f"select ceil({min_support}::double * n) as m from nseq"),
        ("loc", f"select seq_id, item, min(pos) as f, max(pos) as l from {view} group by seq_id, item"),
    ("fr", "select item, count(*) as c from loc group by item having count(*) >= (select m from mc)"),
        ("lf", "select * from loc where item in (select item from fr)"),
    ]


_BASE = _base()

_M = "(select m from mc)"


def _rule_cte(i: int, j: int) -> tuple[str, str]:
    """All rules of i items to j items with enough support: a join of i + j locations."""
    xs, ys = [f"x{k}" for k in range(i)], [f"y{k}" for k in range(j)]
    joins, seen = [f"lf {xs[0]}"], [xs[0]]
    for t in xs[1:] + ys:
        before = [u for u in seen if u[0] == t[0]]
        on = [f"{t}.seq_id = {xs[0]}.seq_id"] + ([f"{t}.item > {before[-1]}.item"] if before else [])
        if t[0] == "y":
            on += [f"{t}.item <> {x}.item" for x in xs] + [f"{x}.f < {t}.l" for x in xs]
        joins.append(f"join lf {t} on {' and '.join(on)}")
        seen.append(t)

    def text(ts: list[str]) -> str:
        return " || ',' || ".join(f"{t}.item" for t in ts)

    return (f"r{i}{j}", f"""select {text(xs)} as antecedent, {text(ys)} as consequent, count(*) as support
  from {' '.join(joins)} group by {', '.join(f'{t}.item' for t in xs + ys)} having count(*) >= {_M}""")


def _cover_cte(largest: int) -> tuple[str, str]:
    parts = []
    for i in range(1, largest + 1):
        ts = [f"x{k}" for k in range(i)]
        joins = " ".join(f"join lf {b} on {b}.seq_id = x0.seq_id and {b}.item > {a}.item" for a, b in zip(ts, ts[1:]))
        text = " || ',' || ".join(f"{t}.item" for t in ts)
        parts.append(f"select {text} as antecedent, count(*) as cover from lf x0 {joins} group by {', '.join(f'{t}.item' for t in ts)}")
    return ("cov", "\n  union all\n".join(parts))


def _rules_sql(parts: list[str], final: str | None = None, view: str = "sequences",
               min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> str:
    body = "\nunion all\n".join(f"select * from {p}" for p in parts)
    sizes = [(int(p[1]), int(p[2])) for p in parts]
    rules = [_rule_cte(i, j) for i, j in sizes] + [_cover_cte(max(i for i, _ in sizes))]
    ctes = _base(view, min_support) + rules + [("allr", body), ("rules", f"""select r.antecedent, r.consequent,
  r.support, r.support / (select n from nseq) as support_rel, r.support / c.cover as confidence
  from allr r join cov c on c.antecedent = r.antecedent where r.support / c.cover >= {min_confidence}""")]
    return W(final or "select * from rules", view, extra=ctes)


@register("frequent_items", W("select item, c as nseq from fr", "sequences", extra=_BASE))
def frequent_items(spark, d):
    seqs = V.sequences(spark, d)
    n = SR.sequence_count(V.daily_events(spark, d))
    return SR.frequent_items(seqs, SR.min_count(n, MIN_SUPPORT))[1]


@register("item_sequences", W("select distinct item, seq_id from sequences", "sequences"))
def item_sequences(spark, d):
    """Item -> sequence index in long form (one row per pair; never one array per item)."""
    return V.daily_events(spark, d).select("item", "seq_id").distinct()


@register("pair_cooccurrence", W("""select a.item as item_a, b.item as item_b, count(*) as n_seq from lf a join lf b
on a.seq_id = b.seq_id and a.item < b.item group by a.item, b.item""", "sequences", extra=_BASE))
def pair_cooccurrence(spark, d):
    seqs = V.sequences(spark, d)
    locf, _ = SR.frequent_items(seqs, SR.min_count(SR.sequence_count(V.daily_events(spark, d)), MIN_SUPPORT))
    return SR.pair_cooccurrence(locf)


@register("pair_cooccurrence_words", W("""select a.item as item_a, b.item as item_b, count(*) as n_seq from lf a join lf b
on a.seq_id = b.seq_id and a.item < b.item group by a.item, b.item""", "sequences", extra=_BASE))
def pair_cooccurrence_words(spark, d):
    """By posting words: a joined row stands for up to 64 sequences."""
    seqs = V.sequences(spark, d)
    locf, _ = SR.frequent_items(seqs, SR.min_count(SR.sequence_count(V.daily_events(spark, d)), MIN_SUPPORT))
    return P.pair_counts(P.posting_words(locf, P.number_sequences(locf)))


@register("item_sequences_words", W("select distinct item, seq_id from sequences where item is not null", "sequences"))
def item_sequences_words(spark, d):
    """The item -> sequence index as posting words, read back."""
    rows = V.daily_events(spark, d).select("item", "seq_id").filter(F.col("item").isNotNull())
    numbers = P.number_sequences(rows)
    return P.sequences_of(P.posting_words(rows, numbers), numbers)


@register("common_sequences", W("""select p.item as item_a, q.item as item_b, r.item as item_c, count(*) as n_seq
from (select distinct seq_id, item from lf) p join (select distinct seq_id, item from lf) q on p.seq_id = q.seq_id and p.item < q.item
join (select distinct seq_id, item from lf) r on q.seq_id = r.seq_id and q.item < r.item
where p.item = (select min(item) from lf) group by all""", "sequences", extra=_BASE))
def common_sequences(spark, d):
    """Sequences that hold the first frequent item and any two others, intersected word by word."""
    seqs = V.sequences(spark, d)
    locf, freq = SR.frequent_items(seqs, SR.min_count(SR.sequence_count(V.daily_events(spark, d)), MIN_SUPPORT))
    words = P.posting_words(locf, P.number_sequences(locf))
    pairs = P.pair_counts(words).join(freq.select(F.min("item").alias("item_a")), "item_a", "left_semi").drop("n_seq")
    sets = pairs.join(pairs.withColumnRenamed("item_b", "item_c"), "item_a").filter("item_b < item_c")
    sets = sets.select(F.struct("item_a", "item_b", "item_c").alias("set_id"), F.array("item_a", "item_b", "item_c").alias("items"))
    return P.set_counts(P.common_words(words, sets), "set_id").select("set_id.*", "n_seq")


@register("seq_rules_1_1", _rules_sql(["r11"]))
def seq_rules_1_1(spark, d):
    return _flat(_mine(spark, d, 1, 1))


@register("seq_rules_2_1", _rules_sql(["r21"]))
def seq_rules_2_1(spark, d):
    r = _mine(spark, d, 2, 1)
    return _flat(r.filter((F.size("antecedent") == 2) & (F.size("consequent") == 1)))


_WEEKLY = {"view": "weekly_sequences", "min_support": WEEKLY_MIN_SUPPORT, "min_confidence": WEEKLY_MIN_CONFIDENCE}


@register("seq_rules_1_2", _rules_sql(["r12"], **_WEEKLY))
def seq_rules_1_2(spark, d):
    """On the weekly sequences, which are long enough to have some."""
    r = SR.sequential_rules(V.weekly_sequences(spark, d), WEEKLY_MIN_SUPPORT, WEEKLY_MIN_CONFIDENCE, 1, 2)
    return _flat(r.filter((F.size("antecedent") == 1) & (F.size("consequent") == 2)))


@register("seq_rules_2_2", _rules_sql(["r22"], view="weekly_sequences", min_support=RARE_SUPPORT, min_confidence=WEEKLY_MIN_CONFIDENCE))
def seq_rules_2_2(spark, d):
    """Rules of two items to two, at a support that some reach."""
    r = SR.sequential_rules(V.weekly_sequences(spark, d), RARE_SUPPORT, WEEKLY_MIN_CONFIDENCE, 2, 2)
    return _flat(r.filter((F.size("antecedent") == 2) & (F.size("consequent") == 2)))


@register("seq_rules", _rules_sql(["r11", "r21", "r12", "r22"]))
def seq_rules(spark, d):
    return _flat(_mine(spark, d, 2, 2))


@register("seq_rules_summary", _rules_sql(["r11", "r21", "r12", "r22"], """select count(distinct antecedent || '>' || consequent)
  as n_rules, (select count(distinct i) from (select unnest(string_split(consequent, ',')) as i from rules))
  as n_consequent_items from rules"""))
def seq_rules_summary(spark, d):
    return SR.rules_summary(_mine(spark, d, 2, 2))


@register("rules_binned", _rules_sql(["r11", "r21", "r12", "r22"], f"""select *,
  floor(confidence * {1 / BIN_INTERVAL}) / {1 / BIN_INTERVAL} as conf_bin from rules"""))
def rules_binned(spark, d):
    r = SR.binned(_mine(spark, d, 2, 2), BIN_INTERVAL)
    return _flat(r).withColumn("conf_bin", F.floor(F.col("confidence") * (1 / BIN_INTERVAL)) / (1 / BIN_INTERVAL))


@register("seq_rules_weekly", _rules_sql(["r11", "r21", "r12", "r22"], **_WEEKLY))
def seq_rules_weekly(spark, d):
    seqs = V.weekly_sequences(spark, d)
    return _flat(SR.sequential_rules(seqs, WEEKLY_MIN_SUPPORT, WEEKLY_MIN_CONFIDENCE, 2, 2))


# Every size of up to five items: one more than the largest frequent rules have at this
# support (1 => 3), so that nothing that the miner should have found is missing.
_ALL = [f"r{i}{j}" for n in (2, 3, 4, 5) for i in range(1, n) for j in [n - i]]


@register("seq_rules_weekly_all", _rules_sql(_ALL, **_WEEKLY))
def seq_rules_weekly_all(spark, d):
    """No caps on either side (0 = no cap): rules of every size the data supports."""
    seqs = V.weekly_sequences(spark, d)
    return _flat(SR.sequential_rules(seqs, WEEKLY_MIN_SUPPORT, WEEKLY_MIN_CONFIDENCE, 0, 0))
