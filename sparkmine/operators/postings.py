"""Sets of sequences per item as posting words: ``(item, word, bits)``, where bit ``b`` of
``bits`` says that sequence number ``64 * word + b`` holds the item.

A row covers a fixed range of 64 sequences, so neither a row nor a key grows with an item
or a sequence: an item in every sequence has one row for each 64 of them, and a word has at
most one row an item. Sets are intersected range by range, by equi-joins on the word, and
counted by bits; up to 64 sequences of a pair meet in one joined row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.session import broadcast_if_small, bucketed_table, shuffle_partitions

BITS = 64


def number_sequences(locs: DataFrame, seq: str = "seq_id") -> DataFrame:
    """``(seq, no long)``: a number for every sequence, consecutive within each part of the
    written table (which fixes them); null is none."""
    nb = shuffle_partitions(locs.sparkSession)
    seqs = locs.select(seq).filter(F.col(seq).isNotNull()).distinct()
    # Ordered within a fixed part, so that a task that runs again gives the same numbers.
    placed = seqs.repartition(nb, seq).sortWithinPartitions(seq)
    return bucketed_table(placed.withColumn("no", F.monotonically_increasing_id()), seq, nb, "numbered", aligned=True)


def posting_words(locs: DataFrame, numbers: DataFrame, seq: str = "seq_id", item: str = "item") -> DataFrame:
    """``(item, word, bits)`` of the rows ``(seq, item)``, repeats allowed; written as a table
    bucketed by word, so that joins on the word have no exchange."""
    rows = locs.select(seq, item).join(numbers, seq)
    bit = F.lit(1).cast("bigint")
    placed = rows.select(item, F.shiftright("no", 6).alias("word"), F.call_function("shiftleft", bit, (F.col("no") % BITS).cast("int")).alias("b"))
    # Partial or-s first: what crosses the shuffle is at most a row a word and item from each task.
    words = placed.groupBy("word", item).agg(F.bit_or("b").alias("bits"))
    return bucketed_table(words, "word", shuffle_partitions(locs.sparkSession), "postings")


def pair_counts(words: DataFrame, item: str = "item") -> DataFrame:
    """Sequences holding both items of a pair, a < b: ``(item_a, item_b, n_seq)``."""
    a = words.select("word", F.col(item).alias("item_a"), F.col("bits").alias("_a"))
    b = words.select("word", F.col(item).alias("item_b"), F.col("bits").alias("_b"))
    both = a.join(b, "word").filter(F.col("item_a") < F.col("item_b"))
    common = F.bit_count(F.col("_a").bitwiseAND(F.col("_b")))
    return (both.select("item_a", "item_b", common.cast("bigint").alias("n")).filter(F.col("n") > 0)
            .groupBy("item_a", "item_b").agg(F.sum("n").alias("n_seq")))


def common_words(words: DataFrame, sets: DataFrame, set_id: str = "set_id", items: str = "items", item: str = "item") -> DataFrame:
    """``(set_id, word, bits)``: the sequences that hold every item of each set of ``sets``
    (``set_id``, ``items`` an array of distinct items); words without any are left out, and so
    are sets without items. Sets come from parameters or a level, words from the data."""
    members = sets.select(set_id, F.size(items).alias("_size"), F.explode(items).alias(item))
    found = words.join(broadcast_if_small(members, members.count(), 96), item)
    both = found.groupBy("word", set_id).agg(F.count(F.lit(1)).alias("_n"), F.first("_size").alias("_size"), F.bit_and("bits").alias("bits"))
    return both.filter((F.col("_n") == F.col("_size")) & (F.col("bits") != 0)).select(set_id, "word", "bits")


def set_counts(common: DataFrame, key: str = "set_id") -> DataFrame:
    """``(key, n_seq)`` of posting words."""
    return common.groupBy(key).agg(F.sum(F.bit_count("bits").cast("bigint")).alias("n_seq"))


def sequences_of(words: DataFrame, numbers: DataFrame, key: str = "item", seq: str = "seq_id") -> DataFrame:
    """Posting words back as rows ``(key, seq)``."""
    places = F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda b: F.getbit("bits", b) == 1)
    numbered = words.select(key, "word", F.explode(places).alias("_b"))
    numbered = numbered.select(key, (F.col("word") * BITS + F.col("_b")).alias("no"))
    return numbered.join(numbers, "no").select(key, seq)
