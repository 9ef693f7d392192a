"""The codec of nested delimited text: any nesting, nulls and empties on every level."""

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmine.session import scratch_path
from sparkmine.sources import delimited as D

DEEP = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("words", T.ArrayType(T.StringType())),
    T.StructField("grid", T.ArrayType(T.ArrayType(T.IntegerType()))),
    T.StructField("book", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    T.StructField("seen", T.ArrayType(T.StructType([
        T.StructField("at", T.DoubleType()), T.StructField("by", T.MapType(T.StringType(), T.IntegerType()))]))),
    T.StructField("one", T.StructType([T.StructField("list", T.ArrayType(T.StringType()))])),
])


def _plain(x):
    if isinstance(x, T.Row):
        return tuple(_plain(v) for v in x)
    if isinstance(x, dict):
        return {k: _plain(v) for k, v in x.items()}
    if isinstance(x, (list, tuple)):
        return [_plain(v) for v in x] if isinstance(x, list) else tuple(_plain(v) for v in x)
    return x


def _round_trip(spark, rows, schema, **form):
    path = scratch_path(spark, "nested")
    D.write_nested_delimited(spark.createDataFrame(rows, schema), path, **form)
    return {r[0]: _plain(r) for r in D.read_nested_delimited(spark, path, schema, **form).collect()}


ROWS = [
    (0, None, None, None, None, None),
    (1, [], [], {}, [], (None,)),
    (2, [""], [[]], {"": []}, [None], ([],)),
    (3, [None], [None], {"k": None}, [(None, None)], ([None],)),
    (4, ["", ""], [[], []], {"a": [""], "b": [None], "c": []}, [(1.5, {}), None], ([""],)),
    (6, [None, None], [[None], None], {"a": [None, None]}, [(None, None), (None, {})], (["", None],)),
    (5, ["x", None, ""], [[1, None], None, [], [None]], {"a": ["x", "y"]}, [(None, {"p": None, "q": 1})], (["x"],)),
]


def test_nulls_and_empties_differ_on_every_level(spark):
    back = _round_trip(spark, ROWS, DEEP)
    assert back == {r[0]: r for r in ROWS}


def test_separators_and_marks_inside_values_with_an_escape(spark):
    odd = ["|", ",", ":", "\\", "\\N", "\\L", "a\\", "\\,", "line\nbreak\r", "\x04\x05", "\\\\", "n", " "]
    rows = [(i, [w], [[i]], {w: [w, w]}, [(0.5, {w: 1})], ([w],)) for i, w in enumerate(odd)] + [(99, odd, None, {w: odd for w in odd}, [], (odd,))]
    assert _round_trip(spark, rows, DEEP, escape="\\") == {r[0]: r for r in rows}
    assert _round_trip(spark, rows[:3], DEEP, escape="^", item="*", key=".", field="+") == {r[0]: r for r in rows[:3]}


_word = st.none() | st.text(st.sampled_from("ab|,:\\NL\n"), max_size=3)
_rows = st.lists(st.tuples(
    st.none() | st.lists(_word, max_size=3), st.none() | st.lists(st.none() | st.lists(st.none() | st.integers(-9, 9), max_size=2), max_size=3),
    st.none() | st.dictionaries(st.text(st.sampled_from("ab:,\\"), max_size=2), st.none() | st.lists(_word, max_size=2), max_size=2),
    st.none() | st.lists(st.none() | st.tuples(st.none() | st.floats(-2, 2), st.none() | st.dictionaries(st.sampled_from("pq"), st.none() | st.integers(0, 3), max_size=2)), max_size=2),
    st.none() | st.tuples(st.none() | st.lists(_word, max_size=2))), min_size=1, max_size=40)


@settings(max_examples=4, deadline=None, phases=[Phase.generate], derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(_rows)
def test_any_values_come_back(spark, rows):
    rows = [(i, *r) for i, r in enumerate(rows)]
    assert _round_trip(spark, rows, DEEP, escape="\\") == {r[0]: r for r in rows}


def test_text_written_elsewhere(spark):
    path = scratch_path(spark, "hive")
    lines = ["1|a,b|1:2,3|HOME:x,WORK:y,HOME:z|||", "2", "3|||nokey,\\N:v,k:|0.5:p\x051,\\N|"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    book = T.MapType(T.StringType(), T.StringType())
    schema = T.StructType([*DEEP.fields[:3], T.StructField("book", book), *DEEP.fields[4:]])
    got = {r[0]: _plain(r) for r in D.read_nested_delimited(spark, path, schema).collect()}
    # A repeated key: its first entry; a null key: none. What a line doesn't have is null.
    assert got[1][:4] == (1, ["a", "b"], [[1, 2], [3]], {"HOME": "x", "WORK": "y"})
    assert got[1][4:] == ([], ([],)) and got[2] == (2, None, None, None, None, None)
    assert got[3][3] == {"nokey": None, "k": ""} and got[3][4] == [(0.5, {"p": 1}), None]


@pytest.mark.parametrize("form", [{"item": "|"}, {"item": "ab"}, {"escape": ","}, {"escape": "xy"}])
def test_forms_that_cannot_be_read_are_refused(spark, form):
    with pytest.raises(ValueError):
        D.write_nested_delimited(spark.createDataFrame(ROWS, DEEP), "unused", **form)


def test_too_deep_nesting_is_refused(spark):
    kind = T.IntegerType()
    for _ in range(8):
        kind = T.ArrayType(kind)
    with pytest.raises(ValueError, match="nested beyond"):
        D.nested_text(F.col("x"), kind)
