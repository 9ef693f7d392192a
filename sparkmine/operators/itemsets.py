"""Frequent itemsets and association rules over long basket tables ``(basket, item)``.

Level-wise (Apriori) counting, expressed as joins on the basket key instead of the
reference's cartesian products:

* level 1: item supports, partially aggregated on the map side;
* level k: candidate sets come before counting: two frequent (k-1)-sets that differ in
  their last item are joined, and a set with an infrequent subset is left out, by joins on
  sets alone. The occurrence table of frequent (k-1)-sets ``(basket, items, last)``, of
  which only sets that a candidate extends are kept, is joined to the basket's frequent
  items on ``basket`` with ``item > last`` and the item among the candidates' (each k-set is
  built once, in sorted order), counted per itemset, thresholded, and semi-joined back.
  The distinct basket table and each level's occurrence table are written as tables
  bucketed by basket in the shared checkpoint folder: the basket join of the next
  level needs no exchange, a lost executor never replays earlier levels, and the plan
  does not grow. With at most ``MASK_ITEMS`` frequent items a set is one bigint of
  item bits (decoded to a sorted array per level), otherwise a sorted array.
* rules: consequents grow item by item, each step an equi-join on the itemset and one on
  the antecedent, pruned by confidence. No cartesian product anywhere.

The join key is the basket, so the work per basket is the number of frequent sets it
contains. Repeats inside a basket are removed before the join, so a basket never holds
more rows than there are distinct frequent items. The bucketed joins have no exchange
that AQE could split: a basket of very many frequent items is dealt to several parts by its
counted size, and its sets stay in their parts, buckets and tasks at every level
(``spread.Parts``).

Rows whose item is null are left out (their baskets don't count by them).

Support semantics: sets of two or more items count baskets. Single items count
baskets (``mode='transaction'``) or occurrences (``mode='occurrence'``, as the
reference does). Threshold = ``max(2, n * min_support)`` with ``>=``, n = baskets.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.operators.spread import Parts
from sparkmine.session import broadcast_if_small, bucketed_table, cached, fits_broadcast, shuffle_partitions

MASK_ITEMS = 62  # up to this many frequent items, sets travel as bits of one bigint


def _check_fraction(name: str, v: float) -> None:
    if not (0 <= v <= 1):
        raise ValueError(f"{name} must be between 0 and 1")


def support_threshold(n: int, min_support: float) -> float:
    """Absolute threshold: ``n * min_support``, never below 2."""
    t = n * min_support
    return 2.0 if t < 2 else t


def item_support(baskets: DataFrame, mode: str = "transaction", basket: str = "basket_id",
                 item: str = "item") -> DataFrame:
    """``(item, support)``: baskets holding the item, or occurrences of it."""
    src = baskets.select(basket, item)
    if mode == "transaction":
        src = src.distinct()
    elif mode != "occurrence":
        raise ValueError("mode must be 'transaction' or 'occurrence'")
    return src.groupBy(item).agg(F.count(F.lit(1)).alias("support"))


def frequent_itemsets(baskets: DataFrame, min_support: float, max_size: int | None = None,
                      mode: str = "transaction", basket: str = "basket_id", item: str = "item",
                      n: int | None = None, mask_items: int = MASK_ITEMS, report: list | None = None) -> DataFrame:
    """All frequent itemsets: ``(items array<string> sorted, size int, support bigint)``.

    ``report``, a list, gets for each level from 2 (size, occurrences of candidates that were
    counted), at the price of a job a level."""
    _check_fraction("min_support", min_support)
    if mode not in ("transaction", "occurrence"):
        raise ValueError("mode must be 'transaction' or 'occurrence'")
    # Distinct (basket, item), hash-partitioned by basket and written once as a table
    # bucketed by basket: the basket count, the supports and every level read it, and
    # each level's occurrence table is bucketed the same way, so the basket join of
    # every level runs without an exchange.
    spark = baskets.sparkSession
    nb = shuffle_partitions(spark)
    baskets = baskets.filter(F.col(item).isNotNull())
    # (repeats go before the rows are dealt by basket)
    tx_all = bucketed_table(baskets.select(F.col(basket).alias("_b"), F.col(item).alias("_i")).distinct(), "_b", nb, "baskets")
    if n is None:
        n = tx_all.agg(F.count_distinct("_b")).first()[0]
    thr = support_threshold(n, min_support)

    if mode == "transaction":
        singles = tx_all.groupBy(F.col("_i").alias(item)).agg(F.count(F.lit(1)).alias("support"))
    else:
        singles = item_support(baskets, mode, basket, item)
    f1 = cached(singles.filter(F.col("support") >= F.lit(thr)))
    n1 = f1.count()
    levels = [f1.select(F.array(F.col(item)).alias("items"), F.lit(1).alias("size"), "support")]
    if (max_size is not None and max_size < 2) or n1 == 0:
        return levels[0]

    # Baskets' frequent items only (repeats already gone); a broadcast semi-join keeps
    # the basket partitioning.
    tx = tx_all.join(broadcast_if_small(f1.select(F.col(item).alias("_i")), n1), "_i", "left_semi")
    # With few frequent items, a set is the bigint of its items' bits (bit = rank of the
    # item in a parameter-sized dictionary, so bit order = item order); otherwise a
    # sorted array. Levels are decoded to sorted arrays as they are emitted.
    masked = n1 <= mask_items
    if masked:
        names = sorted(r[0] for r in f1.select(item).collect())
        code = F.create_map(*[x for i, name in enumerate(names) for x in (F.lit(name), F.lit(i))])
        tx = tx.select("_b", F.try_element_at(code, F.col("_i")).cast("int").alias("_i"))
        dictionary = F.array(*[F.lit(x) for x in names])

        def one(c: Column) -> Column:
            return _pow2(c)

        def grow(items: Column, c: Column) -> Column:
            return items.bitwiseOR(_pow2(c))

        def decode(items: Column) -> Column:
            return F.filter(dictionary, lambda x, i: items.bitwiseAND(_pow2(i)) != 0)
    else:
        def one(c: Column) -> Column:
            return F.array(c)

        def grow(items: Column, c: Column) -> Column:
            return F.concat(items, F.array(c))

        def decode(items: Column) -> Column:
            return items
    parts = Parts(tx, "_b")
    if parts.hot is None:
        tx = dealt = parts.copied(tx)
    else:
        tx, dealt = (bucketed_table(x, "_k", nb, "parted") for x in (parts.copied(tx), parts.dealt(tx, "_i")))
    occ = dealt.select("_k", one(F.col("_i")).alias("items"), F.col("_i").alias("_last"))

    k = 2
    while max_size is None or k <= max_size:
        nxt = tx.select("_k", F.col("_i").alias("_next"))
        wide = 16 if masked else 32 * (k + 1)  # bytes of a set
        fits = F.col("_next") > F.col("_last")
        if k > 2:
            extensions = cached(candidate_extensions(fk, k, masked))
            ne = extensions.count()
            if ne == 0:
                break
            occ = occ.join(broadcast_if_small(extensions, ne, wide + (16 if masked else 32 * n1)), "items")
            fits &= F.col("_allowed").bitwiseAND(_pow2(F.col("_next"))) != 0 if masked else F.array_contains("_allowed", F.col("_next"))
        # Candidate occurrences of this level (co-partitioned join on the basket),
        # computed once and reused for the counts and the next occurrence table.
        cand = (occ.join(nxt, "_k").filter(fits)
                .select("_k", grow(F.col("items"), F.col("_next")).alias("items"), F.col("_next").alias("_last"))
                .persist(StorageLevel.MEMORY_AND_DISK))
        if report is not None:
            report.append((k, cand.count()))
        fk = cached(cand.groupBy("items").agg(F.count(F.lit(1)).alias("support"))
                    .filter(F.col("support") >= F.lit(thr)))
        nk = fk.count()
        if nk == 0:
            cand.unpersist()
            break
        levels.append(fk.select(decode(F.col("items")).alias("items"), F.lit(k).alias("size"), "support"))
        # Frequent sets broadcast behind their counted size: the semi-join keeps the
        # basket partitioning for the next level.
        occ = bucketed_table(cand.join(broadcast_if_small(fk.select("items"), nk, wide), "items", "left_semi"),
                             "_k", nb, "itemset_level", aligned=fits_broadcast(nk, wide))
        cand.unpersist()
        k += 1

    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    return out


def candidate_extensions(frequent: DataFrame, size: int, masked: bool) -> DataFrame:
    """``(items, _allowed)``: for each of the ``frequent`` sets of ``size - 1`` >= 2 items the
    items behind its last one with which it makes a candidate of ``size``: both sets without
    one of the two last items are frequent (they share the items before, on which they are
    joined), and so is every set without one of those. ``_allowed`` is a mask or an array of
    frequent items at most. No basket is read."""
    c = F.col
    if masked:
        last = F.length(F.bin("items")) - 1
        sets = frequent.select("items", last.alias("_l"), (c("items") - _pow2(last)).alias("_p"))
        grown = c("items").bitwiseOR(_pow2(c("_next")))
        bits = F.filter(F.sequence(F.lit(0), F.lit(MASK_ITEMS)), lambda i: c("_p").bitwiseAND(_pow2(i)) != 0)
        subsets = F.transform(bits, lambda i: grown - _pow2(i))
        allowed = F.bit_or(_pow2(c("_next")))
    else:
        sets = frequent.select("items", F.element_at("items", -1).alias("_l"), F.slice("items", 1, size - 2).alias("_p"))
        grown = F.concat("items", F.array("_next"))
        subsets = F.transform(F.sequence(F.lit(0), F.lit(size - 3)), lambda i: F.filter(grown, lambda x, j: j != i))
        allowed = F.collect_set("_next")
    pairs = sets.join(sets.select("_p", c("_l").alias("_next")), "_p").filter(c("_l") < c("_next"))
    each = pairs.select("items", "_next", F.explode(subsets).alias("_sub"))
    held = each.join(frequent.select(c("items").alias("_sub")), "_sub", "left_semi")
    whole = held.groupBy("items", "_next").agg(F.count(F.lit(1)).alias("_n")).filter(c("_n") == size - 2)
    return whole.groupBy("items").agg(allowed.alias("_allowed"))


def _pow2(i: Column) -> Column:
    return F.pow(F.lit(2), i).cast("bigint")


def _rules(itemsets: DataFrame, min_confidence: float) -> DataFrame:
    """Rules grown consequent by consequent: from ``I \\ Y => Y`` to one more item in Y.

    Moving an item from the antecedent to the consequent never raises the confidence, so
    only rules that are confident enough grow, and only by items that are a confident
    consequent of I by themselves. Each step is an equi-join on the itemset and one on the
    antecedent; the number of steps is the size of the largest set less one."""
    multi = itemsets.filter(F.col("size") >= 2)
    largest = multi.agg(F.max("size")).first()[0] or 0
    cover = itemsets.select(F.col("items").alias("antecedent"), F.col("support").alias("_cover"))

    def confident(rows: DataFrame) -> DataFrame:
        antecedent = F.array_except("items", "consequent")
        return rows.withColumn("antecedent", antecedent).join(cover, "antecedent").withColumn(
            "confidence", F.col("support") / F.col("_cover")).drop("_cover").filter(F.col("confidence") >= F.lit(min_confidence))

    level = cached(confident(multi.select("items", "size", "support", F.explode("items").alias("_y"))
                             .withColumn("consequent", F.array("_y"))))
    single = level.select("items", F.col("_y").alias("_next"))
    found = [level]
    for n in range(2, largest):
        grown = level.filter(F.col("size") > n).join(single, "items").filter(F.col("_next") > F.col("_y"))
        level = cached(confident(grown.select(
            "items", "size", "support", F.col("_next").alias("_y"),
            F.concat("consequent", F.array("_next")).alias("consequent"))))
        if level.isEmpty():
            break
        found.append(level)
    out = [x.select("antecedent", "consequent", "support", "confidence") for x in found]
    rules = out[0]
    for x in out[1:]:
        rules = rules.unionByName(x)
    return rules


def candidate_rules(itemsets: DataFrame) -> DataFrame:
    """Every rule ``A => I \\ A`` for a frequent I (size >= 2) and proper non-empty A,
    with support of I and confidence sup(I) / sup(A); no confidence filter. A set of k
    items has 2^k - 2 of them: ask for a confidence where sets are large."""
    return _rules(itemsets, 0.0)


def association_rules(itemsets: DataFrame, min_confidence: float) -> DataFrame:
    """Rules with confidence ``>= min_confidence``."""
    _check_fraction("min_confidence", min_confidence)
    return _rules(itemsets, min_confidence)


def predict(rules: DataFrame, items: list[str], min_confidence: float) -> DataFrame:
    """Rules whose antecedent is exactly the given set (any order), confidence ``>=``.
    Pass the unfiltered ``candidate_rules`` as the reference does."""
    if not isinstance(items, list):
        raise ValueError('"items" should be a list')
    key = F.array(*[F.lit(x) for x in sorted(items)])
    return rules.filter((F.col("antecedent") == key) & (F.col("confidence") >= F.lit(min_confidence)))


def predict_batch(rules: DataFrame, queries: DataFrame, min_confidence: float, items: str = "items") -> DataFrame:
    """Batch form: for each query row, the rules whose antecedent equals its item set."""
    q = queries.withColumn("antecedent", F.array_sort(F.array_distinct(F.col(items))))
    return q.join(rules.filter(F.col("confidence") >= F.lit(min_confidence)), "antecedent")


def frequent_itemsets_fpgrowth(baskets: DataFrame, min_support: float, basket: str = "basket_id",
                               item: str = "item") -> DataFrame:
    """Second path: Spark ML's parallel FP-growth over one item array per basket
    (transaction support). It needs each basket's distinct items in one row, so it
    suits baskets of bounded size (orders, sessions); the join path above has no such
    requirement. Same output and threshold (``>= max(2, n * min_support)``)."""
    from pyspark.ml.fpm import FPGrowth

    _check_fraction("min_support", min_support)
    sets = (baskets.select(basket, item).distinct()
            .groupBy(basket).agg(F.collect_list(item).alias("items")))
    model = FPGrowth(itemsCol="items", minSupport=min_support).fit(sets)
    found = model.freqItemsets
    return found.filter(F.col("freq") >= 2).select(
        F.array_sort("items").alias("items"), F.size("items").alias("size"), F.col("freq").alias("support"))
