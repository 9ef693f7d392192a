"""Line-oriented sources: text lines, basket lines, sequence lines, vector lines, and a
stable line id (the DataFrame form of ``zipWithIndex``) for head samples.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmine.session import broadcast_if_small, cached

# The 17 clickstream categories, in code order (code 1 = first name).
CATEGORIES = (
    "frontpage news tech local opinion on-air misc weather msn-news health living business "
    "msn-sports sports summary bbs travel"
).split()

def read_text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value`` per line of every matching text file (``*.txt`` globs allowed)."""
    return spark.read.text(path)


def with_line_id(df: DataFrame, name: str = "line_id") -> DataFrame:
    """Contiguous 0-based line numbers in file order: by file path, then split offset,
    then position inside the split. ``df`` must be a direct file scan.

    One aggregate counts the lines of each split. Splits are summed up within their file,
    and only files (which the driver lists anyway) in one sequence. Every line then gets
    its split's offset plus its place in its scan task, which is a pure function of the
    file listing, so a re-read after a lost executor yields the same ids; no copy of the
    input is made. Lines meet their split by a 24-byte row, broadcast if all of them fit.
    If the two scans should cut the files differently, the query fails instead of losing
    lines."""
    base = df.select("*", F.xxhash64("_metadata.file_path").alias("_f"),
                     F.col("_metadata.file_block_start").alias("_blk"),
                     F.monotonically_increasing_id().alias("_mid"))
    counted = df.select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_blk"),
                        F.monotonically_increasing_id().alias("_mid"))
    splits = cached(counted.groupBy("_path", "_blk").agg(F.min("_mid").alias("_m0"), F.count(F.lit(1)).alias("_n")))
    within = Window.partitionBy("_path").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
    files = splits.groupBy("_path").agg(F.sum("_n").alias("_lines"))
    files = files.select("_path", F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_file"))
    offs = splits.withColumn("_in", F.coalesce(F.sum("_n").over(within), F.lit(0))).join(files, "_path")
    offs = offs.select(F.xxhash64("_path").alias("_f"), "_blk", "_m0", (F.col("_file") + F.col("_in")).alias("_off"))
    out = base.join(broadcast_if_small(offs, splits.count(), 40), ["_f", "_blk"], "left")
    number = F.when(F.col("_off").isNull(), F.raise_error(F.lit("the scan's splits have changed")).cast("long")).otherwise(
        F.col("_off") + F.col("_mid") - F.col("_m0"))
    return out.withColumn(name, number).drop("_f", "_blk", "_mid", "_m0", "_off")


def without_first_lines(df: DataFrame) -> DataFrame:
    """Text lines without the first of each file. ``df`` must be a direct file scan.

    One aggregate finds the first row of each file's first split by its place in its scan
    task, as ``with_line_id`` does; one row a file is joined, broadcast if all of them fit."""
    placed = df.select(F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_blk"),
                       F.monotonically_increasing_id().alias("_mid"))
    found = placed.filter(F.col("_blk") == 0).groupBy("_f").agg(F.min("_mid").alias("_m0"))
    rows = found.select(F.xxhash64("_f"), "_m0").collect()  # one a file, and the driver lists those anyway
    first = df.sparkSession.createDataFrame(rows, "_f long, _m0 long")
    lines = df.select("*", F.xxhash64("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_blk"),
                      F.monotonically_increasing_id().alias("_mid"))
    out = lines.join(broadcast_if_small(first, len(rows), 24), "_f", "left")
    own = F.when(F.col("_blk") != 0, True).when(F.col("_mid") >= F.col("_m0"), F.col("_mid") > F.col("_m0")).otherwise(
        F.raise_error(F.lit("the scan's splits have changed")).cast("boolean"))
    return out.filter(own).drop("_f", "_blk", "_mid", "_m0")


def read_head_lines(spark: SparkSession, path: str | list[str], k: int | None = None, fraction: float | None = None) -> DataFrame:
    """``(line_id, value)`` of the first ``k`` lines, or of the first ``int(n * fraction)``, in
    file order; only the leading files that hold them are read for it.

    With ``k``, files are counted in growing runs from the first one, until there are enough;
    the others aren't opened. A fraction needs the number of all lines, so every file is
    counted once."""
    if (k is None) == (fraction is None) or not 0 <= (fraction or 0) <= 1 or (k or 0) < 0:
        raise ValueError("give k >= 0 or a fraction in [0, 1]")
    files = sorted(spark.read.text(path).inputFiles())
    if k is None:
        counts = dict(_line_counts(spark, files))
        k = int(sum(counts.values()) * fraction)
        leading, seen = [], 0
        for f in files:
            if seen >= k:
                break
            leading.append(f)
            seen += counts[f]
    else:
        seen, upto, run = 0, 0, 1
        while upto < len(files) and seen < k:
            seen += sum(n for _, n in _line_counts(spark, files[upto:upto + run]))
            upto, run = upto + run, run * 4
        leading = files[:upto]
    if k == 0 or not leading:
        return spark.createDataFrame([], "line_id long, value string")
    return head_lines(with_line_id(read_text_lines(spark, leading)), k=k).select("line_id", "value")


def _line_counts(spark: SparkSession, files: list[str]) -> list[tuple[str, int]]:
    """Lines of each of the files (one row a file, as the driver lists them anyway)."""
    if not files:
        return []
    counted = read_text_lines(spark, files).groupBy(F.col("_metadata.file_path").alias("f")).count().collect()
    found = {r["f"].replace("file:///", "file:/"): r["count"] for r in counted}
    return [(f, found.get(f.replace("file:///", "file:/"), 0)) for f in files]


def head_lines(df_with_id: DataFrame, fraction: float | None = None, k: int | None = None,
               name: str = "line_id") -> DataFrame:
    """First ``int(n * fraction)`` lines, or the first ``k`` lines, in file order."""
    if k is None:
        if fraction is None or not (0 <= fraction <= 1):
            raise ValueError("give k or a fraction in [0, 1]")
        k = int(df_with_id.count() * fraction)
    return df_with_id.filter(F.col(name) < k)


def read_baskets(spark: SparkSession, path: str | list[str], sep: str = ",") -> DataFrame:
    """``(basket_id, pos, item)``: one basket per line, items split by ``sep`` with no
    trimming; repeats kept; a blank line is one basket holding one empty item."""
    lines = with_line_id(read_text_lines(spark, path), "basket_id")
    return lines.select("basket_id", F.posexplode(F.split("value", _quote(sep), -1)).alias("pos", "item"))


def read_sequences(spark: SparkSession, path: str | list[str], names: list[str] | None = CATEGORIES,
                   sep: str = "blank") -> DataFrame:
    """``(seq_id, pos, item, category)`` from lines of integer codes separated by blanks
    (``.seq`` files, ``sep='blank'``) or by commas (``.csv`` files, ``sep=','``).
    Header lines (``%``), blank lines and other non-numeric lines are dropped; codes
    outside 1..len(names) get a null category (never a wrapped-around one)."""
    lines = read_text_lines(spark, path)
    split_re, extra = (r"\s+", "") if sep == "blank" else (r"\s*" + _quote(sep) + r"\s*", _quote(sep))
    # Only digits, blanks and separators, at least one digit (no repeated regex group:
    # lines may be long).
    numeric = F.col("value").rlike("[0-9]") & ~F.col("value").rlike(r"[^0-9\s" + extra + "]")
    lines = with_line_id(lines, "seq_id").filter(numeric)
    body = F.regexp_replace("value", r"^\s+|\s+$", "")
    seqs = lines.select("seq_id", F.posexplode(F.split(body, split_re, -1)).alias("pos", "_code"))
    seqs = seqs.select("seq_id", F.col("pos").cast("bigint").alias("pos"), F.col("_code").cast("int").alias("item"))
    if not names:
        return seqs
    dim = spark.createDataFrame([(i + 1, n) for i, n in enumerate(names)], "item int, category string")
    return seqs.join(F.broadcast(dim), "item", "left").select("seq_id", "pos", "item", "category")


def read_vectors(spark: SparkSession, path: str | list[str], sep: str = ",") -> DataFrame:
    """``v array<double>`` per line; blanks around numbers are allowed (``1, 2``)."""
    lines = read_text_lines(spark, path).filter(F.trim("value") != "")
    parts = F.split("value", _quote(sep), -1)
    return lines.select(F.transform(parts, lambda x: F.trim(x).try_cast("double")).alias("v"))


def _quote(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?{}[]\|()" else ch for ch in s)
