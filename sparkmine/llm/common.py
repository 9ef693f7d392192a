"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.session import checkpoint_dir, scratch_path

# White space of every word rule here: blank and the ASCII controls 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"\x20\x09-\x0D"

# A lookup table is broadcast only up to this many rows (a few tens of bytes each).
LOOKUP_ROWS = 100_000
SALTS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs in the whole text; null counts 0."""
    words = F.regexp_replace(text, f"[{BLANK_CLASS}]*+[^{BLANK_CLASS}]++", "x")
    return F.coalesce(F.length(F.rtrim(words, F.lit(BLANKS))), F.lit(0)).cast("long")


def crc_bucket(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; -1 for a null key."""
    return F.coalesce(F.crc32(key.cast("string")) % modulus, F.lit(-1)).cast("int")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once and standing in the plan once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def materialised(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: the lineage ends
    there, so a lost executor never replays what came before."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_lookup(df: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with the columns of ``small`` (unique by ``keys``, which match null-safely).

    ``small`` should be materialised: it is counted, broadcast up to ``LOOKUP_ROWS``
    rows, and otherwise joined by a shuffle in which each key is spread over ``SALTS``
    tasks, so that a key with a third of all rows doesn't land in one of them."""
    extra = [c for c in small.columns if c not in keys]
    names = {k: f"__lookup_{i}" for i, k in enumerate(keys)}
    right = small.select(*[F.col(k).alias(names[k]) for k in keys], *extra)
    on = [df[k].eqNullSafe(right[names[k]]) for k in keys]
    if small.count() <= LOOKUP_ROWS:
        return df.join(F.broadcast(right), on, "inner").drop(*names.values())
    left = df.withColumn("__salt", F.floor(F.rand(17) * SALTS).cast("int"))
    right = right.withColumn("__salt_r", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    on = [left[k].eqNullSafe(right[names[k]]) for k in keys] + [left["__salt"] == right["__salt_r"]]
    return left.join(right, on, "inner").drop("__salt", "__salt_r", *names.values())
