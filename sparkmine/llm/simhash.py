"""SimHash near-duplicate detection by multi-index hashing.

A text's fingerprint has 64 bits; a bit is 1 if it is set in over half of the XXH64
hashes (seed 42) of its word shingles, repeats included. Fingerprints at ``max_distance``
or fewer differing bits are linked, and the links' components are the groups.

Only distinct fingerprints are linked, so exact copies cost one partial aggregate. The 64
bits are cut into segments; by the pigeonhole principle two linked fingerprints differ by
at most one bit in some segment. Each fingerprint is posted under its segments' values; it
then looks up each segment's value and those with one set bit cleared (of two values that
differ in one bit, one finds the other), and every match is verified on all 64 bits.

A segment value under which more than ``HOT_POSTINGS`` distinct fingerprints are posted
(a family of near copies) would make pairs in the square of its size. Such postings, and
whoever looks them up, are linked exactly in another way: two fingerprints are within two
bits if and only if one 64-bit value is within one bit of both. Each is posted under the 65
values within one bit of it, and every value links its fingerprints to the smallest.

Defined cases: null and blank texts have no shingle and fingerprint 0, linked like any
other; fewer words than the shingle length make one shingle of all of them; repeated rows
share fingerprint and group; a null id never names a group unless all its ids are null;
an empty table gives no rows; of other columns those asked for are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.common import materialised
from sparkmine.llm.components import connected_components

HOT_POSTINGS = 512
SHINGLES_AT_ONCE = 65_536


def simhash(text: bytes | None, shingle: int) -> int:
    """The fingerprint of one UTF-8 text as a signed 64-bit integer. A-Z is lower-cased;
    words are runs of bytes other than blank and the controls 9 to 13."""
    import numpy as np
    import xxhash

    words = (text or b"").lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return 0
    total = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, total, SHINGLES_AT_ONCE):
        part = words[start:start + SHINGLES_AT_ONCE + shingle - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
        hashes = np.array([xxhash.xxh64_intdigest(g, 42) for g in grams], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """The fingerprint of a string column, as a long."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return of(text.cast("binary"))


def _segments(max_distance: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment; few enough differing bits for one bit each."""
    n = max_distance // 2 + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return list(zip(cuts, (b - a for a, b in zip(cuts, cuts[1:]))))


def _clear_one(value: Column, width: int) -> Column:
    """The value itself and each value with one of its set bits cleared."""
    cleared = [value.bitwiseAND(F.lit(~(1 << i) if i < 63 else (1 << 63) - 1)) for i in range(width)]
    return F.array_distinct(F.array(value, *cleared))


def hamming_links(fingerprints: DataFrame, max_distance: int = 2, hot: int = HOT_POSTINGS) -> DataFrame:
    """Links (a, b) between distinct fingerprints, a column ``fp`` of unique longs, whose
    components are those of all pairs at ``max_distance`` (0 to 2) or fewer bits."""
    if not 0 <= max_distance <= 2:
        raise ValueError("max_distance must be 0, 1 or 2")
    fp, segments = F.col("fp"), _segments(max_distance)
    values = [
        fp if width == 64 else F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1)) for low, width in segments]

    def in_segment(i: int, array: Column) -> Column:
        return F.transform(array, lambda v: F.struct(F.lit(i).alias("segment"), v.alias("value")))

    def exploded(arrays: list[Column]) -> DataFrame:
        both = F.flatten(F.array(*[in_segment(i, a) for i, a in enumerate(arrays)]))
        return fingerprints.select("fp", F.explode(both).alias("s")).select("fp", "s.segment", "s.value")

    table = exploded([F.array(v) for v in values])
    probes = exploded([_clear_one(v, width) for v, (_, width) in zip(values, segments)])
    crowded = materialised(table.groupBy("segment", "value").count().filter(F.col("count") > hot).select("segment", "value"), "crowded")
    stars = None
    if max_distance == 2 and not crowded.isEmpty():
        near = probes.join(crowded, ["segment", "value"], "left_semi").select("fp").distinct()
        flips = [fp.bitwiseXOR(F.lit((1 << i) if i < 63 else -(1 << 63))) for i in range(64)]
        posted = near.select("fp", F.explode(F.array(fp, *flips)).alias("middle"))
        least = posted.groupBy("middle").agg(F.min("fp").alias("least"))
        stars = posted.join(least, "middle").filter("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b"))
        table = table.join(crowded, ["segment", "value"], "left_anti")
    right = table.select(F.col("fp").alias("b"), F.col("segment").alias("seg"), F.col("value").alias("val"))
    found = probes.join(right, (F.col("segment") == F.col("seg")) & (F.col("value") == F.col("val")) & (F.col("fp") != F.col("b")))
    links = found.filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= max_distance).select(F.col("fp").alias("a"), "b")
    return links if stars is None else links.union(stars)


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (),
                    shingle: int = 3, max_distance: int = 2, root: str | None = None) -> DataFrame:
    """One row per row of ``docs``: its id, the columns ``keep``, fingerprint (16 hex
    digits) and component_id, the smallest id of its group. ``root``, if given, names one
    more column, the group's smallest fingerprint as a long: groups of null ids only share
    the component_id null, but never that."""
    prints = materialised(docs.select(doc_id, *keep, fingerprint(F.col(text), shingle).alias("__fp")), "fingerprints")
    classes = materialised(prints.groupBy(F.col("__fp").alias("fp")).agg(F.min(doc_id).alias("least")), "classes")
    roots = connected_components(hamming_links(classes.select("fp"), max_distance))
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(groups, "root").select("fp", "component_id", F.col("root").alias("__root"))
    extra = [F.col("__root").alias(root)] if root else []
    return prints.join(named, F.col("__fp") == F.col("fp")).select(
        doc_id, *keep, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", *extra)
