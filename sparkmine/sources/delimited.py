"""Delimited text sources and sinks with declared schemas (never inferred), as Pig and
Hive read and write them: a line is cut at every separator, there is no quote or escape
character, ``\\N`` is null, an empty field is an empty string, and blanks are kept. A value
that isn't of its column's type (also one with blanks around a number), and a field that
a short line doesn't have, are null; fields beyond the schema are ignored.
Nested delimited text (Hive ``ROW FORMAT DELIMITED`` with collection and map-key
terminators) nests any way: a separator a level, see ``write_nested_delimited``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmine.sources.files import replace_output
from sparkmine.sources.lines import without_first_lines

NULL = "\\N"  # how null is written


def _schema(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)


def field(parts: Column, i: int, dtype: T.DataType) -> Column:
    """Field ``i`` of a line's parts, typed."""
    text = F.when(F.get(parts, i) != NULL, F.get(parts, i))
    if isinstance(dtype, T.StringType):
        return text
    return F.when(text == F.trim(text), text).try_cast(dtype.simpleString())


def fields(line: Column, schema: T.StructType | str, sep: str) -> list[Column]:
    """The typed columns of a line of delimited text."""
    parts = F.split(line, regex_quote(sep), -1)
    return [field(parts, i, f.dataType).alias(f.name) for i, f in enumerate(_schema(schema).fields)]


def read_delimited(spark: SparkSession, path: str | list[str], schema: T.StructType | str, sep: str = "\t",
                   header: bool = False) -> DataFrame:
    """Delimited text with declared columns; ``path`` may be a glob (``ad_data[12]``).
    ``header``: the first line of each file is left out, and nothing else: blank lines are
    rows, with a header as without."""
    lines = spark.read.text(path)
    if header:
        lines = without_first_lines(lines)
    return lines.select(*fields(F.col("value"), schema, sep))


_ROW_BITS = (1 << 33) - 1  # of a monotonically increasing id, those that count a task's rows


def _write_lines(lines: DataFrame, path: str, header: bool, mode: str) -> None:
    """``lines``: one string column, named like the header, which stands before the first
    line of each file."""
    name = lines.columns[0]
    out = lines.select(F.col(f"`{name}`").alias("value"))
    if header:
        first = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)) == 0
        out = out.select(F.when(first, F.concat(F.lit(name + "\n"), F.col("value"))).otherwise(F.col("value")).alias("value"))
    if mode == "overwrite":
        replace_output(lines.sparkSession, path, out.write.text)
    else:
        out.write.mode(mode).text(path)


def write_delimited(df: DataFrame, path: str, sep: str = "\t", header: bool = False,
                    mode: str = "overwrite", single_file: bool = False) -> None:
    """Delimited sink; ``mode='overwrite'`` replaces the output of an earlier run once the
    new one is whole. Values are written as they are: one that holds the separator reads
    back as two fields. ``single_file`` funnels through one task: only for small, bounded
    results."""
    out = df.coalesce(1) if single_file else df
    values = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(NULL)) for c in df.columns]
    _write_lines(out.select(F.concat_ws(sep, *values).alias(sep.join(df.columns))), path, header, mode)


def regex_quote(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?{}[]\|()" else ch for ch in s)


# ---- nested text -----------------------------------------------------------------------

# The separators of the levels below those that a table names.
DEEPER = ("\x04", "\x05", "\x06", "\x07", "\x08")
LONE = "\\L"  # stands before a collection's text that would read as none, or as so marked
# With an escape character: what escaped characters are while a line is cut. They are
# code points that Unicode keeps for such use, and no text's characters.
_HIDDEN = [chr(c) for c in range(0xFDD0, 0xFDF0)]


class _Nested:
    """The separators of a nested format and its escapes."""

    def __init__(self, field: str, item: str, key: str, escape: str | None):
        self.seps = (field, item, key, *DEEPER)
        if len(set(self.seps)) < len(self.seps) or any(len(s) != 1 for s in self.seps):
            raise ValueError("separators must be different single characters")
        if escape is not None and (len(escape) != 1 or escape in self.seps):
            raise ValueError("escape must be a single character that separates nothing")
        self.escape = escape
        # (character, how it is written behind the escape, what it is while lines are cut)
        written = [(s, s) for s in (escape or "", *self.seps)] + [("\n", "n"), ("\r", "r")]
        self.special = [(c, w, h) for (c, w), h in zip(written, _HIDDEN)] if escape is not None else []

    def sep(self, level: int) -> str:
        if level >= len(self.seps):
            raise ValueError(f"nested beyond {len(self.seps)} separators")
        return self.seps[level]

    def split(self, text: Column, level: int, limit: int = -1) -> Column:
        return F.split(text, regex_quote(self.sep(level)), limit)

    def hide(self, line: Column) -> Column:
        for c, w, h in self.special:
            line = F.replace(line, F.lit(self.escape + w), F.lit(h))
        return line

    def leaf(self, text: Column) -> Column:
        for c, _, h in self.special:
            text = F.replace(text, F.lit(h), F.lit(c))
        return text

    def escaped(self, text: Column) -> Column:
        for c, w, _ in self.special:  # the escape itself first
            text = F.replace(text, F.lit(c), F.lit(self.escape + w))
        return text


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _parse(text: Column, dtype: T.DataType, level: int, form: _Nested) -> Column:
    """A value of type ``dtype`` from its text, whose parts ``form.sep(level)`` separates."""

    def parts(t: Column, empty: bool) -> Column:
        marked = F.when(F.startswith(t, F.lit(LONE)), form.split(F.substring(t, F.lit(len(LONE) + 1), F.length(t)), level))
        if empty:
            marked = marked.when(t == "", F.array().cast("array<string>"))
        return marked.otherwise(form.split(t, level))

    def parsed(t: Column) -> Column:
        if isinstance(dtype, T.ArrayType):
            return F.transform(parts(t, True), lambda x: _parse(x, dtype.elementType, level + 1, form))
        if isinstance(dtype, T.StructType):
            return _let(parts(t, False), lambda p: F.struct(
                *[_parse(F.get(p, i), f.dataType, level + 1, form).alias(f.name) for i, f in enumerate(dtype.fields)]))
        if isinstance(dtype, T.MapType):
            def entry(x: Column) -> Column:
                return _let(form.split(x, level + 1, 2), lambda kv: F.struct(
                    _parse(F.get(kv, 0), dtype.keyType, level + 2, form).alias("k"),
                    _parse(F.get(kv, 1), dtype.valueType, level + 2, form).alias("v")))

            entries = F.when(t == "", F.array().cast("array<string>")).otherwise(form.split(t, level))
            named = F.filter(F.transform(entries, entry), lambda e: e["k"].isNotNull())
            return _let(named, lambda es: F.map_from_entries(F.filter(
                es, lambda e, i: F.array_position(F.transform(es, lambda o: o["k"]), e["k"]) == i + 1)))
        whole = form.leaf(t)
        if isinstance(dtype, T.StringType):
            return whole
        return F.when(whole == F.trim(whole), whole).try_cast(dtype.simpleString())

    return F.when(text.isNotNull() & (text != NULL), parsed(text))


def nested_text(c: Column, dtype: T.DataType, item: str = ",", key: str = ":", field: str = "|", escape: str | None = None) -> Column:
    """One column as nested text (see ``write_nested_delimited``); never null."""
    return _text(c, dtype, 1, _Nested(field, item, key, escape))


def _text(c: Column, dtype: T.DataType, level: int, form: _Nested) -> Column:
    def marked(joined: Column, n: Column) -> Column:
        reads_like_none = (n == 1) & ((joined == "") | (joined == NULL))
        return F.when(reads_like_none | F.startswith(joined, F.lit(LONE)), F.concat(F.lit(LONE), joined)).otherwise(joined)

    if isinstance(dtype, T.ArrayType):
        inner = F.transform(c, lambda x: _text(x, dtype.elementType, level + 1, form))
        text = _let(F.array_join(inner, form.sep(level)), lambda t: marked(t, F.size(c)))
    elif isinstance(dtype, T.StructType):
        inner = [_text(c[f.name], f.dataType, level + 1, form) for f in dtype.fields]
        text = _let(F.concat_ws(form.sep(level), *inner), lambda t: marked(t, F.lit(len(inner))))
    elif isinstance(dtype, T.MapType):
        text = F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(
            _text(e["key"], dtype.keyType, level + 2, form), F.lit(form.sep(level + 1)),
            _text(e["value"], dtype.valueType, level + 2, form))), form.sep(level))
    else:
        text = form.escaped(c.cast("string"))
    return F.when(c.isNotNull(), text).otherwise(F.lit(NULL))


def read_nested_delimited(spark: SparkSession, path: str, schema: T.StructType, field: str = "|",
                          item: str = ",", key: str = ":", escape: str | None = None) -> DataFrame:
    """What ``write_nested_delimited`` writes, and other text of this form: an empty text is
    an empty array or map; struct members and map values that a text doesn't have are null;
    of a repeated map key the first entry counts, and an entry with a null key is left out."""
    form = _Nested(field, item, key, escape)
    parts = F.split("line", regex_quote(field), -1)
    lines = spark.read.text(path).select(form.hide(F.col("value")).alias("line"))
    return lines.select(*[_parse(F.get(parts, i), f.dataType, 1, form).alias(f.name) for i, f in enumerate(schema.fields)])


def write_nested_delimited(df: DataFrame, path: str, field: str = "|", item: str = ",", key: str = ":",
                           mode: str = "overwrite", escape: str | None = None) -> None:
    """Rows as nested delimited text, of any nesting of arrays, structs and maps.

    ``field`` separates columns; the elements of an array, the members of a struct and the
    entries of a map are separated by ``item``, in the level below by ``key``, and further
    down by ``DEEPER``; a map's keys stand before its values behind the next level's
    separator. Null is ``\\N`` on every level, and an empty collection an empty text. A
    collection of one element whose text is that of null or empty, and one whose text starts
    with it, has ``LONE`` before its text: [null], [""], [[]] and [] all differ.

    Without ``escape``, as in a table that names none, strings must not hold separators in
    use or line breaks, nor be ``\\N`` or start with ``LONE``. With it (one character) every
    value comes back, but for noncharacters of Unicode (U+FDD0 to U+FDEF)."""
    form = _Nested(field, item, key, escape)
    texts = [_text(F.col(f"`{f.name}`"), f.dataType, 1, form) for f in df.schema.fields]
    _write_lines(df.select(F.concat_ws(field, *texts).alias("value")), path, False, mode)
