"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws one exponential key, divided by its quality weight; within a
source the documents are taken in the order of these keys until the source's budget of
words is full. A budget larger than its source first takes complete epochs (every
document once each) and only the rest by keys.

No source is sorted as a whole. Keys fall into ordered bins; one aggregate gives the
words of each (source, bin), a running sum over bins finds the bin in which the budget
ends, and only that bin is ordered document by document. So a source with a third of all
rows costs one partial aggregate like any other.

Defined cases: a null source is a source of its own, ranked last; a null or negative
size counts 0; a null or non-positive quality weight counts as the smallest weight; rows
with equal key and id (repeated rows) share what the budget's end leaves them in
proportion to their sizes; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.llm.common import materialised, with_lookup, word_count

MIN_QUALITY = 0.05
MIN_BINS = 1024
ROWS_PER_BIN = 100_000
CYCLE = (1, 2, 3)


def letter_share(text: Column) -> Column:
    """A document's quality weight in [MIN_QUALITY, 1]: letters and blanks among all its
    characters. Null and empty texts get the smallest weight."""
    odd = F.length(F.regexp_replace(text, r"[\p{L}\s]++", ""))
    share = F.try_divide(F.length(text) - odd, F.length(text))
    return F.greatest(F.lit(MIN_QUALITY), F.coalesce(share, F.lit(0.0)))


def sampling_key(doc_id: Column, quality: Column, seed: int) -> Column:
    """-ln(u) / weight with u in (0, 1) from a hash of the id: the same on every run."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id), 11).cast("double")
    weight = F.when(quality > MIN_QUALITY, quality).otherwise(F.lit(MIN_QUALITY))
    return -F.log((bits + 0.5) / float(1 << 53)) / weight


def source_targets(sizes: DataFrame, cycle: tuple[int, ...], share: float, max_epochs: int) -> DataFrame:
    """(source, source_size, weight, target): ``share`` of all words dealt by weight.

    Sources by code point, null last, weigh ``cycle``, repeating. A target stops at
    ``max_epochs`` times its source; the excess goes to the others by weight, until none
    is above. ``sizes``: (source, source_size, docs), one row per source."""
    ordered = sizes.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    ordered = materialised(ordered.withColumn("part", F.spark_partition_id()), "sources")
    parts = ordered.groupBy("part").count()  # as many rows as partitions
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    weights = F.array(*[F.lit(w) for w in cycle])
    ranked = ordered.withColumn("inside", inside).join(F.broadcast(parts), "part")
    place = ((F.col("before") + F.col("inside") - 1) % len(cycle) + 1).cast("int")
    ranked = materialised(
        ranked.select("source", "source_size", "docs", F.element_at(weights, place).cast("long").alias("weight")), "ranked")
    cap = F.col("source_size") * max_epochs
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    budget, level = total * share, 0.0
    while True:  # each round caps at least one more source, else it ends
        capped = F.lit(level) * F.col("weight") > cap
        row = ranked.agg(
            F.sum(F.when(capped, cap).otherwise(0)).alias("full"),
            F.sum(F.when(capped, 0).otherwise(F.col("weight"))).alias("open")).first()
        if not row["open"]:
            break
        new = (budget - row["full"]) / row["open"]
        if new <= level:
            break
        level = new
    return ranked.withColumn("target", F.least(F.lit(level) * F.col("weight"), cap.cast("double")))


def mix_sources(docs: DataFrame, *, doc_id: str = "doc_id", source: str = "source", size: str = "size",
                quality: str = "quality", cycle: tuple[int, ...] = CYCLE, share: float = 1.0, max_epochs: int = 3,
                whole_documents: bool = False, seed: int = 42) -> DataFrame:
    """``docs`` with source_size, target (of its source) and taken, the words that the mix
    takes of the row, repeats counted.

    ``size`` and ``quality`` name columns of ``docs``. The document at which a budget ends
    gives its first words only; with ``whole_documents`` it is taken whole if that brings
    the source nearer to its target, and else not. No row gives more than ``max_epochs``
    times its size. The columns source_size, target and taken of ``docs`` are replaced."""
    kept = [c for c in docs.columns if c not in ("source_size", "target", "taken")]
    size_col = F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("long")
    key_col = sampling_key(F.col(doc_id), F.col(quality), seed)
    narrow = materialised(
        docs.select(F.col(doc_id).alias("id"), F.col(source).alias("source"), size_col.alias("size"),
                    key_col.alias("key")), "mix")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    targets = materialised(source_targets(sizes, cycle, share, max_epochs), "targets")

    largest = targets.agg(F.max("docs")).first()[0] or 0
    bins = max(MIN_BINS, -(-largest // ROWS_PER_BIN))
    # Increasing in the key; about even for weights around 0.9.
    bin_of = F.floor((F.lit(1.0) - F.exp(-0.9 * F.col("key"))) * bins).cast("long")
    epochs = F.floor(F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0)))
    epochs = F.least(epochs, F.lit(max_epochs)).cast("long")
    plan = targets.withColumn("epochs", epochs).withColumn(
        "rest", F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))

    per_bin = narrow.groupBy("source", bin_of.alias("bin")).agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("bin")
    per_bin = per_bin.withColumn("before", F.sum("words").over(upto) - F.col("words"))
    per_bin = with_lookup(per_bin, materialised(plan.select("source", "rest"), "rests"), ["source"])
    ends = materialised(
        per_bin.filter((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest")))
        .select("source", F.col("bin").alias("end_bin"), "before", "rest"), "ends")

    last = with_lookup(narrow.withColumn("bin", bin_of), ends, ["source"]).filter(F.col("bin") == F.col("end_bin"))
    last = last.groupBy("source", "end_bin", "key", "id").agg(
        F.sum("size").alias("tied"), F.first("before").alias("before"), F.first("rest").alias("rest"))
    order = Window.partitionBy("source").orderBy("key", F.col("id").asc_nulls_first())
    last = last.withColumn("before", F.col("before") + F.sum("tied").over(order) - F.col("tied"))
    cut = last.filter(F.col("before") + F.col("tied") > F.col("rest")).groupBy("source", "end_bin").agg(
        F.min(F.struct("key", "id", "before", "tied", "rest")).alias("cut"))
    plan = materialised(plan.join(
        cut.select(F.col("source").alias("s"), "end_bin", "cut"), F.col("source").eqNullSafe(F.col("s")), "left")
        .select("source", "source_size", "target", "epochs", "end_bin", "cut"), "plan")
    plan = plan.select(*[F.col(c).alias(f"__{c}") for c in plan.columns])

    work = docs.select(*kept).withColumns({"__n": size_col, "__key": key_col, "__source": F.col(source)})
    work = with_lookup(work, plan, ["__source"])
    end = F.col("__cut")
    here = (F.col("__key") == end["key"]) & F.col(doc_id).eqNullSafe(end["id"])
    earlier = (F.col("__key") < end["key"]) | (
        (F.col("__key") == end["key"]) & ~here
        & (F.col(doc_id).isNull() | F.coalesce(F.col(doc_id) < end["id"], F.lit(False))))
    left = end["rest"] - end["before"]
    if whole_documents:
        part = F.when(2 * left >= end["tied"], F.col("__n")).otherwise(F.lit(0))
    else:
        part = F.floor(left * F.col("__n") / F.greatest(end["tied"], F.lit(1)))
    extra = F.when(end.isNull(), F.lit(0)).when(here, part).when(earlier, F.col("__n")).otherwise(F.lit(0))
    return work.select(
        *kept, F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
        (F.col("__epochs") * F.col("__n") + extra).cast("long").alias("taken"))


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with size (words) and quality (letter share), the inputs of the mix."""
    return docs.withColumns({"size": word_count(F.col(text)), "quality": letter_share(F.col(text))})
