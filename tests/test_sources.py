"""Readers, writers and tables on hand-made files in the checkpoint folder."""

from pyspark.sql import types as T

from sparkmine.session import scratch_path
from sparkmine.sources import delimited as D
from sparkmine.sources import lines as L
from sparkmine.sources import tables as TB

HEADER = ["% Different categories found in input file:", "", " ".join(L.CATEGORIES), "", "% Sequences:", ""]
FIRST = ["1 1 ", "2 ", "3 2 2 4 2 2 2 3 3 ", "5 ", "1 "]


def _write_lines(spark, lines, name):
    path = scratch_path(spark, name)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_read_sequences_drops_header(spark):
    path = _write_lines(spark, HEADER + FIRST + ["18 0"], "seq")
    rows = L.read_sequences(spark, path).orderBy("seq_id", "pos").collect()
    seqs = {}
    for r in rows:
        seqs.setdefault(r.seq_id, []).append((r.item, r.category))
    got = list(seqs.values())
    assert got[0] == [(1, "frontpage"), (1, "frontpage")]
    assert got[2][0] == (3, "tech")
    assert got[-1] == [(18, None), (0, None)]
    assert len(got) == 6


def test_line_ids_in_file_order(spark):
    path = scratch_path(spark, "ordered")
    spark.range(0, 1000, numPartitions=4).selectExpr("cast(id as string) as value").write.text(path)
    df = L.with_line_id(L.read_text_lines(spark, path))
    assert all(int(r.value) == r.line_id for r in df.collect())
    assert L.head_lines(df, fraction=0.1).count() == 100


def test_baskets_keep_blank_lines(spark):
    path = _write_lines(spark, ["a,b,a", ""], "bask")
    rows = L.read_baskets(spark, path).collect()
    assert sorted(r.item for r in rows) == ["", "a", "a", "b"]
    assert len({r.basket_id for r in rows}) == 2


def test_vectors_with_blanks(spark):
    path = _write_lines(spark, ["1, 2", "10,0", ""], "vec")
    assert sorted(tuple(r.v) for r in L.read_vectors(spark, path).collect()) == [(1.0, 2.0), (10.0, 0.0)]


def test_delimited_bad_value_is_null(spark):
    path = _write_lines(spark, ["x\t 3", "y\tz"], "tsv")
    rows = D.read_delimited(spark, path, "k string, n int").orderBy("k").collect()
    assert rows[0].n is None and rows[1].n is None  # ' 3' keeps its blank; 'z' is no int


ODD_FIELDS = [('"quoted', 1), ('mid"dle', 2), ('"both"', 3), ("", 4), (None, 5), (" blanks ", None), ("back\\slash", 7), ("'", 8)]


def test_quotes_nulls_and_empty_strings(spark):
    path = _write_lines(spark, ['"quoted\t1', "\\N\t2", "\t3", "short", 'a"b\t\\N\textra'], "plain")
    rows = D.read_delimited(spark, path, "k string, n int").collect()
    assert [tuple(r) for r in rows] == [('"quoted', 1), (None, 2), ("", 3), ("short", None), ('a"b', None)]


def test_delimited_round_trip(spark):
    df = spark.createDataFrame(ODD_FIELDS, "k string, n int")
    for sep in ("\t", "|", ","):
        for header in (False, True):
            path = scratch_path(spark, "odd")
            D.write_delimited(df, path, sep=sep, header=header)
            back = D.read_delimited(spark, path, "k string, n int", sep=sep, header=header)
            assert sorted(map(tuple, back.collect()), key=repr) == sorted(ODD_FIELDS, key=repr)


def test_external_table_reads_as_hive_does(spark):
    path = scratch_path(spark, "ext")
    D.write_delimited(spark.createDataFrame(ODD_FIELDS, "k string, n int"), path, sep="|")
    schema = T._parse_datatype_string("k string, n int")
    t = TB.create_external_table(spark, "t_ext", schema, path, sep="|")
    assert sorted(map(tuple, t.collect()), key=repr) == sorted(ODD_FIELDS, key=repr)
    TB.drop_table(spark, "t_ext")
    assert not spark.catalog.tableExists("t_ext") and D.read_delimited(spark, path, schema, sep="|").count() == len(ODD_FIELDS)


def test_line_ids_over_files_of_several_splits(spark):
    path = scratch_path(spark, "splits")
    spark.range(0, 30_000, numPartitions=3).selectExpr("cast(id as string) as value").write.text(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        df = L.with_line_id(L.read_text_lines(spark, path))
        assert df.rdd.getNumPartitions() > 12
        assert df.filter("cast(value as long) <> line_id").count() == 0 and df.count() == 30_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_nested_roundtrip_and_lookups(spark):
    schema = T.StructType([
        T.StructField("id", T.IntegerType()),
        T.StructField("phone", T.MapType(T.StringType(), T.StringType())),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("val", T.StructType([T.StructField("min", T.IntegerType()), T.StructField("total", T.IntegerType())])),
    ])
    path = _write_lines(spark, ["1|HOME:555,WORK:666|7,8,9|1,10", "2|WORK:1|5|2,3"], "nested")
    df = D.read_nested_delimited(spark, path, schema)
    rows = {r.id: r for r in df.selectExpr("id", "try_element_at(phone, 'HOME') as home", "get(ids, 2) as third",
                                          "val.total as total").collect()}
    assert (rows[1].home, rows[1].third, rows[1].total) == ("555", 9, 10)
    assert (rows[2].home, rows[2].third, rows[2].total) == (None, None, 3)
    out = scratch_path(spark, "nested_out")
    D.write_nested_delimited(df, out)
    assert sorted(D.read_nested_delimited(spark, out, schema).collect()) == sorted(df.collect())


def test_table_lifecycle(spark):
    loc = scratch_path(spark, "tbl")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, level string")
    TB.create_typed_table(spark, "t_life", df, loc)
    TB.append_into(spark, "t_life", spark.createDataFrame([(3, "c")], "id int, level string"))
    assert spark.table("t_life").count() == 3
    assert [(r.col_name, r.data_type) for r in TB.describe(spark, "t_life").collect()][:2] == [
        ("id", "int"), ("level", "string")]
    TB.rename_column(spark, "t_life", "level", "status", scratch_path(spark, "tbl2"))
    assert "status" in spark.table("t_life").columns
    TB.rename_table(spark, "t_life", "t_life2")
    assert {r.tableName for r in TB.show_tables(spark).collect()} >= {"t_life2"}
    TB.drop_table(spark, "t_life2")


def test_read_comma_sequences(spark):
    path = _write_lines(spark, ["1,1", "3, 2,2", ""], "seqcsv")
    rows = L.read_sequences(spark, path, sep=",").orderBy("seq_id", "pos").collect()
    assert [(r.item, r.category) for r in rows] == [(1, "frontpage"), (1, "frontpage"), (3, "tech"),
                                                   (2, "news"), (2, "news")]
