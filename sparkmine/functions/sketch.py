"""The most frequent items of each group by mergeable bounded counts (Misra and Gries), so
that only counters, not all distinct items, cross the shuffle.

A sketch of a group holds at most ``capacity`` items with counts. Counting goes on exactly
until there are twice as many; then the (capacity + 1)-th largest count is taken off all of
them, what isn't positive goes, and the group's ``lost`` grows by it. Merging adds the counts
and the losses of two sketches and cuts down in the same way. Whatever the order of rows and
merges: an item's true count lies between its count here and that plus ``lost``; ``lost`` is
at most occurrences / (capacity + 1); every item that occurs more often than ``lost`` is held;
and a group of at most ``capacity`` distinct items is exact (``lost`` 0).
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need pandas alone

HELD = 500_000  # counters that a task holds before it passes its sketches on


def cut(counts: Counter, capacity: int) -> int:
    """Cut ``counts`` down to ``capacity`` items; what every count lost."""
    if len(counts) <= capacity:
        return 0
    lost = sorted(counts.values(), reverse=True)[capacity]
    for item in [i for i, n in counts.items() if n <= lost]:
        del counts[item]
    for item in counts:
        counts[item] -= lost
    return lost


_SKETCH = "g string, items array<string>, counts array<long>, lost long"


def _rows(sketches: dict[str | None, list]) -> pd.DataFrame:
    return pd.DataFrame([(g, list(c), list(c.values()), lost) for g, (c, lost) in sketches.items()],
                        columns=["g", "items", "counts", "lost"])


def _counted(capacity: int):
    """A task's rows (g, items) to one sketch a group."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own: dict[str | None, list] = {}
        held = 0
        for batch in batches:
            for g, items in zip(batch["g"], batch["items"]):
                if items is None or not len(items):
                    continue
                sketch = own.setdefault(g, [Counter(), 0])
                held -= len(sketch[0])
                sketch[0].update(items)
                if len(sketch[0]) > 2 * capacity:
                    sketch[1] += cut(sketch[0], capacity)
                held += len(sketch[0])
                if held > HELD:
                    yield _rows(own)
                    own, held = {}, 0
        for sketch in own.values():
            sketch[1] += cut(sketch[0], capacity)
        yield _rows(own)

    return count


def _merged(capacity: int):
    """Sketches in the order of their groups to one a group; it holds one at a time."""

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: str | None = None
        counts: Counter = Counter()
        lost, open_group = 0, False
        for batch in batches:
            out = {}
            for s in batch.itertuples():
                if open_group and s.g != last:
                    lost += cut(counts, capacity)
                    out[last] = [counts, lost]
                    counts, lost = Counter(), 0
                last, open_group = s.g, True
                for item, n in zip(s.items, s.counts):
                    counts[item] += n
                lost += s.lost
                if len(counts) > 2 * capacity:
                    lost += cut(counts, capacity)
            yield _rows(out)
        if open_group:
            lost += cut(counts, capacity)
            yield _rows({last: [counts, lost]})

    return merge


def heavy_hitters(df: DataFrame, group: str, items: Column, capacity: int) -> DataFrame:
    """``(group, item, n, lost)``: at most ``capacity`` items of each group of ``df``, where
    ``items`` is an array of strings. Null is a group like any other, null items are left out,
    and a group without items has no row. A hot group's rows stay in the tasks that read them."""
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    rows = df.select(F.col(group).cast("string").alias("g"), F.filter(items, lambda x: x.isNotNull()).alias("items"))
    sketches = rows.mapInPandas(_counted(capacity), _SKETCH)
    merged = sketches.repartition("g").sortWithinPartitions("g").mapInPandas(_merged(capacity), _SKETCH)
    each = merged.select("g", "lost", F.explode(F.arrays_zip("items", "counts")).alias("c"))
    return each.select(F.col("g").cast(df.schema[group].dataType).alias(group), F.col("c.items").alias("item"),
                       F.col("c.counts").alias("n"), "lost")
