"""Header files, replaced outputs, moved files and heads that stop reading."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmine.session import scratch_path
from sparkmine.sources import delimited as D
from sparkmine.sources import files as FS
from sparkmine.sources import lines as L
from sparkmine.sources import tables as TB


def _lines(spark, path, values, parts=1):
    spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, value string").repartitionByRange(parts, "i").select("value").write.text(path)
    return path


@pytest.mark.parametrize("header", [False, True])
def test_rows_of_empty_fields_are_rows(spark, header):
    rows = [("", ""), (" ", ""), ("\t".strip(), " "), ("a", "b"), ("", "")]
    path = scratch_path(spark, "blank")
    D.write_delimited(spark.createDataFrame(rows, "a string, b string"), path, sep="\t", header=header)
    back = D.read_delimited(spark, path, "a string, b string", header=header).collect()
    assert sorted(map(tuple, back)) == sorted(rows)
    path = scratch_path(spark, "blank1")
    D.write_delimited(spark.createDataFrame([("",), ("x",), ("",)], "a string").coalesce(1), path, header=header)
    assert sorted(r.a for r in D.read_delimited(spark, path, "a string", header=header).collect()) == ["", "", "x"]


def test_only_each_file_s_first_line_is_a_header(spark):
    base = scratch_path(spark, "headers")
    for i in range(4):  # one empty, one with nothing but the header, repeats of the header's text
        _lines(spark, f"{base}/f{i}", [[], ["k\tn"], ["k\tn", "", "k\tn", "v2\t2"], ["k\tn", "", "k\tn", "v3\t3"]][i])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (old, "4b"):  # files of one split, and of several
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = D.read_delimited(spark, f"{base}/*", "k string, n string", header=True).collect()
            want = [("", None), ("k", "n"), ("v2", "2"), ("", None), ("k", "n"), ("v3", "3")]
            assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_header_of_a_file_of_many_splits(spark):
    path = scratch_path(spark, "long")
    spark.range(0, 20_000, numPartitions=2).selectExpr("cast(id as string) as value").write.option("header", "true").csv(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
        got = D.read_delimited(spark, path, "value int", header=True)
        assert got.rdd.getNumPartitions() > 4
        assert got.agg(F.count("value"), F.sum("value"), F.count(F.lit(1))).first() == (20_000, sum(range(20_000)), 20_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_a_failed_job_leaves_the_earlier_output(spark):
    path = scratch_path(spark, "kept")
    D.write_delimited(spark.range(5).selectExpr("cast(id as string) as x"), path)
    bad = spark.range(0, 1000, numPartitions=4).select(F.when(F.col("id") == 900, F.raise_error(F.lit("half-way")))
                                                       .otherwise(F.col("id").cast("string")).alias("x"))
    with pytest.raises(Exception, match="half-way"):
        D.write_delimited(bad, path)
    assert sorted(r.x for r in D.read_delimited(spark, path, "x string").collect()) == list("01234")
    assert [n for n in os.listdir(_local(os.path.dirname(path))) if n.startswith(os.path.basename(path) + ".")] == []
    # The next one replaces it, also where it reads what it replaces.
    D.write_delimited(D.read_delimited(spark, path, "x string").filter("x > '2'"), path)
    assert sorted(r.x for r in D.read_delimited(spark, path, "x string").collect()) == ["3", "4"]


def _local(path):
    return path.removeprefix("file:")


def _bytes(folder):
    folder = _local(folder)
    return sorted(open(os.path.join(folder, n), "rb").read() for n in os.listdir(folder) if not n.startswith(("_", ".")))


def test_load_moves_files(spark):
    loc, one, two = (scratch_path(spark, n) for n in ("table", "one", "two"))
    D.write_delimited(spark.createDataFrame([("a", 1)], "k string, n int"), loc, sep="|", single_file=True)
    TB.create_external_table(spark, "t_load", T._parse_datatype_string("k string, n int"), loc, sep="|")
    _lines(spark, one, ["b|2", "", "c|\\N"])
    _lines(spark, two, ["d|4"])
    # A name that is taken: the second folder's file is called like the first one's.
    name = next(n for n in os.listdir(_local(one)) if n.startswith("part-"))
    own = next(n for n in os.listdir(_local(two)) if n.startswith("part-"))
    FS._rename(spark, f"{two}/{own}", f"{two}/{name}")
    before = _bytes(loc) + _bytes(one) + _bytes(two)
    assert spark.table("t_load").count() == 1
    assert TB.load_files(spark, "t_load", one) == [name]
    stem, ext = os.path.splitext(name)
    assert TB.load_files(spark, "t_load", two) == [f"{stem}_copy_1{ext}"]
    assert sorted(map(tuple, spark.table("t_load").collect()), key=repr) == sorted([("a", 1), ("b", 2), ("", None), ("c", None), ("d", 4)], key=repr)
    assert _bytes(loc) == sorted(before)
    for folder in (one, two):
        assert [n for n in os.listdir(_local(folder)) if not n.startswith(".")] == []
    _lines(spark, f"{one}/again", ["z|26"])
    assert len(TB.load_files(spark, "t_load", f"{one}/again", overwrite=True)) == 1
    assert [tuple(r) for r in spark.table("t_load").collect()] == [("z", 26)]
    with pytest.raises(ValueError):
        FS.move_files(spark, one, loc)  # it holds a folder
    TB.drop_table(spark, "t_load")


def test_free_names():
    assert FS.free_name("a.txt", set()) == "a.txt"
    assert FS.free_name("a.txt", {"a.txt", "a_copy_1.txt"}) == "a_copy_2.txt"
    assert FS.free_name("a", {"a"}) == "a_copy_1"


def test_a_head_opens_leading_files_only(spark):
    path = _lines(spark, scratch_path(spark, "many"), [str(i) for i in range(1000)], parts=20)
    files = len(spark.read.text(path).inputFiles())
    assert files == 20
    for k, most in ((0, 0), (1, 1), (60, 5), (400, 21), (5000, 20)):
        head = L.read_head_lines(spark, path, k=k)
        assert [(r.line_id, r.value) for r in head.orderBy("line_id").collect()] == [(i, str(i)) for i in range(min(k, 1000))]
        assert len(head.inputFiles()) <= most
    half = L.read_head_lines(spark, path, fraction=0.1)
    assert half.count() == 100 and len(half.inputFiles()) <= 3
    assert L.read_head_lines(spark, path, fraction=0.0).count() == 0 and L.read_head_lines(spark, path, fraction=1.0).count() == 1000
    for bad in ({"k": -1}, {}, {"fraction": 2.0}, {"k": 1, "fraction": 0.5}):
        with pytest.raises(ValueError):
            L.read_head_lines(spark, path, **bad)
