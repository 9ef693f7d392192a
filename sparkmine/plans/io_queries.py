"""Registered source, sink and table queries.

Each writes a table derived from the driver's parquet (by Spark, over the whole table)
into the shared checkpoint folder in the reference's text format, reads it back with
our readers, and returns the result; the oracle computes the same rows from the
parquet tables directly.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmine.functions import text as TX
from sparkmine.operators import itemsets as I
from sparkmine.operators import relational as R
from sparkmine.plans import views as V
from sparkmine.plans.catalog import register
from sparkmine.plans.oracle_views import with_views as W
from sparkmine.session import scratch_path
from sparkmine.sources import delimited as D
from sparkmine.sources import files as FS
from sparkmine.sources import lines as L
from sparkmine.sources import tables as TB

AD1 = ("keyword string, campaign_id string, date string, time string, display_site string, was_clicked int, "
       "cpc int, country string, placement string")
AD2 = ("campaign_id string, date string, time string, display_site string, placement string, was_clicked int, "
       "cpc int, keyword string")
CLEAN = ("campaign_id string, date string, time string, keyword string, display_site string, placement string, "
         "was_clicked int, cpc int")
EMP = "emp_id string, fname string, lname string, state string, job_title string, salary int"
LOYALTY = T.StructType([
    T.StructField("cust_id", T.IntegerType()),
    T.StructField("fname", T.StringType()),
    T.StructField("lname", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("level", T.StringType()),
    T.StructField("phone", T.MapType(T.StringType(), T.StringType())),
    T.StructField("order_ids", T.ArrayType(T.IntegerType())),
    T.StructField("order_value", T.StructType([T.StructField(n, T.IntegerType()) for n in ("min", "max", "avg", "total")])),
])
HEAD_FRACTION = 0.1


def _cols(ddl: str) -> list[str]:
    return [p.strip().split(" ")[0] for p in ddl.split(",")]


def _uid() -> str:
    return uuid.uuid4().hex[:10]


# ---- delimited ad data -----------------------------------------------------------------

@register("src_tsv", W(f"select {', '.join(_cols(AD1))} from ads", "ads"))
def src_tsv(spark, d):
    path = scratch_path(spark, "ad_data_tsv")
    D.write_delimited(V.ads(spark, d).select(*_cols(AD1)), path, sep="\t")
    return D.read_delimited(spark, path, AD1, sep="\t")


@register("src_csv", W(f"select {', '.join(_cols(AD2))} from ads", "ads"))
def src_csv(spark, d):
    path = scratch_path(spark, "ad_data_csv")
    D.write_delimited(V.ads(spark, d).select(*_cols(AD2)), path, sep=",")
    return D.read_delimited(spark, path, AD2, sep=",")


@register("src_tsv_header", W("select * from employees", "employees"))
def src_tsv_header(spark, d):
    path = scratch_path(spark, "employees_header")
    D.write_delimited(V.employees(spark, d), path, sep="\t", header=True)
    return D.read_delimited(spark, path, EMP, sep="\t", header=True)


@register("src_header_blank", W("""select case when salary % 3 = 0 then '' else state end as state,
  case when salary % 3 = 0 then '' else job_title end as job_title, count(*) as num
from employees group by all""", "employees"))
def src_header_blank(spark, d):
    """Header files in which a third of the rows holds empty fields only."""
    path = scratch_path(spark, "employees_blank")
    e = V.employees(spark, d)
    rows = e.select(*[F.when(F.col("salary") % 3 == 0, "").otherwise(F.col(c)).alias(c) for c in ("state", "job_title")])
    D.write_delimited(rows, path, sep="\t", header=True)
    back = D.read_delimited(spark, path, "state string, job_title string", sep="\t", header=True)
    return back.groupBy("state", "job_title").agg(F.count(F.lit(1)).alias("num"))


@register("src_glob", W("""select campaign_id, date, time, upper(trim(keyword)) as keyword, display_site, placement,
was_clicked, cpc from ads""", "ads"))
def src_glob(spark, d):
    """Reads ``ad_data[12]``: the USA and CAN folders, not the third copy beside them."""
    base = scratch_path(spark, "ads_by_country")
    ads = V.ads(spark, d)
    D.write_delimited(R.etl_country(ads, "USA"), f"{base}/ad_data1")
    D.write_delimited(R.etl_country(ads, "CAN"), f"{base}/ad_data2")
    D.write_delimited(ads.select(*R.CLEAN_AD_COLUMNS), f"{base}/ad_data3")
    return D.read_delimited(spark, f"{base}/ad_data[12]", CLEAN)


# ---- text lines ------------------------------------------------------------------------

_DOC_LINES = "select unnest(string_split(text, chr(10))) as line from documents"


def _doc_lines(spark, d, ordered: bool = False) -> str:
    path = scratch_path(spark, "documents_txt")
    docs = V.table(spark, d, "documents")
    if ordered:
        docs = docs.orderBy("doc_id")
    docs.select("text").write.text(path)
    return path


@register("src_text_lines", f"select line as value, count(*) as count from ({_DOC_LINES}) group by line")
def src_text_lines(spark, d):
    path = _doc_lines(spark, d)
    lines = L.read_text_lines(spark, f"{path}/*.txt")
    return lines.groupBy("value").agg(F.count(F.lit(1)).alias("count"))


@register("src_baskets", f"""select item, count(*) as support from
(select unnest(string_split(line, ',')) as item from ({_DOC_LINES})) group by item""")
def src_baskets(spark, d):
    path = _doc_lines(spark, d)
    return I.item_support(L.read_baskets(spark, path, ","), "occurrence")


@register("head_fraction", f"""with l as (select doc_id, unnest(string_split(text, chr(10))) as value,
  generate_subscripts(string_split(text, chr(10)), 1) as i from documents),
n as (select row_number() over (order by doc_id, i) - 1 as line_id, value from l)
select line_id, value from n where line_id < (select cast(floor(count(*) * {HEAD_FRACTION}) as bigint) from n)""")
def head_fraction(spark, d):
    """First ``int(n * 0.1)`` lines of a text folder, in file order."""
    path = _doc_lines(spark, d, ordered=True)
    lines = L.with_line_id(L.read_text_lines(spark, path))
    return L.head_lines(lines, fraction=HEAD_FRACTION).select("line_id", "value")


_CATS = ", ".join(f"({i + 1}, '{n}')" for i, n in enumerate(L.CATEGORIES))


HEAD_LINES = 150


@register("head_lines", f"""with l as (select doc_id, unnest(string_split(text, chr(10))) as value,
  generate_subscripts(string_split(text, chr(10)), 1) as i from documents)
select row_number() over (order by doc_id, i) - 1 as line_id, value from l order by doc_id, i limit {HEAD_LINES}""")
def head_lines(spark, d):
    """The first lines of a folder of many files, of which the leading ones are read."""
    path = scratch_path(spark, "documents_many")
    V.table(spark, d, "documents").repartitionByRange(16, "doc_id").sortWithinPartitions("doc_id").select("text").write.text(path)
    return L.read_head_lines(spark, path, k=HEAD_LINES)


@register("src_sequences", f"""with w as (select doc_id, unnest(string_split_regex(trim(text), '\\s+')) as word
  from documents),
c as (select doc_id, length(word) % 17 + 1 as code from w),
cat as (select * from (values {_CATS}) t(code, category))
select cat.category, count(*) as visits, count(distinct c.doc_id) as sequences
from c join cat on c.code = cat.code group by cat.category""")
def src_sequences(spark, d):
    """Clickstream-format file (``%`` header, names line, one line of codes per
    sequence), read back with category names; visits and sequences per category."""
    path = scratch_path(spark, "clickstream")
    docs = V.table(spark, d, "documents")
    codes = F.transform(F.split(F.trim("text"), r"\s+", -1), lambda w: ((F.length(w) % 17) + 1).cast("string"))
    body = docs.select(F.concat_ws(" ", codes).alias("value"))
    header = spark.createDataFrame(
        [("% Different categories found in input file:",), ("",), (" ".join(L.CATEGORIES),), ("",),
         ("% Sequences:",), ("",)], "value string")
    header.coalesce(1).write.text(f"{path}/0-header")
    body.write.text(f"{path}/1-body")
    seqs = L.read_sequences(spark, [f"{path}/0-header", f"{path}/1-body"])
    return seqs.groupBy("category").agg(F.count(F.lit(1)).alias("visits"),
                                        F.count_distinct("seq_id").alias("sequences"))


@register("src_vectors", W("""select dim, count(*) as n, round(sum(x), 6) as sum_x from
(select cast(generate_subscripts(v, 1) - 1 as int) as dim, unnest(v) as x from vectors) group by dim""", "vectors"))
def src_vectors(spark, d):
    path = scratch_path(spark, "vectors_txt")
    vec = V.vectors(spark, d)
    vec.select(F.array_join(F.transform("v", lambda x: x.cast("string")), ", ").alias("value")).write.text(path)
    back = L.read_vectors(spark, path)
    long = back.select(F.posexplode("v").alias("dim", "x"))
    return long.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("x"), 6).alias("sum_x"))


# ---- nested delimited text -----------------------------------------------------------------

_LOYALTY_SQL = """select cast(c_custkey as int) as cust_id, c_mktsegment as fname, c_name as lname,
  'c' || cast(c_custkey as varchar) || '@example.com' as email,
  case when c_acctbal >= 5000 then 'GOLD' else 'SILVER' end as level,
  case when c_custkey % 3 = 0 then null else cast(4440000 + c_custkey as varchar) end as home_phone,
  case when c_custkey % 4 >= 2 then cast(c_custkey * 10 + 2 as int) end as order_id_2,
  cast(tot as int) as total
from customer join (select o_custkey, sum(floor(o_totalprice)) as tot from orders group by o_custkey) o
  on c_custkey = o_custkey"""


def _loyalty(spark, d):
    """Loyalty records (map, array and struct columns) for every customer with orders."""
    c = V.table(spark, d, "customer")
    o = V.table(spark, d, "orders").groupBy("o_custkey").agg(
        F.min(F.floor("o_totalprice")).alias("mn"), F.max(F.floor("o_totalprice")).alias("mx"),
        F.floor(F.avg(F.floor("o_totalprice"))).alias("av"), F.sum(F.floor("o_totalprice")).alias("tot"))
    j = c.join(o, c.c_custkey == o.o_custkey)
    key = F.col("c_custkey")
    home = (key + 4440000).cast("string")
    work = (key + 5550000).cast("string")
    phone = F.when(key % 3 == 0, F.create_map(F.lit("WORK"), work)).otherwise(
        F.create_map(F.lit("HOME"), home, F.lit("WORK"), work))
    return j.select(
        key.cast("int").alias("cust_id"), F.col("c_mktsegment").alias("fname"), F.col("c_name").alias("lname"),
        F.concat(F.lit("c"), key.cast("string"), F.lit("@example.com")).alias("email"),
        F.when(F.col("c_acctbal") >= 5000, "GOLD").otherwise("SILVER").alias("level"),
        phone.alias("phone"),
        F.transform(F.sequence(F.lit(0).cast("bigint"), key % 4), lambda i: (key * 10 + i).cast("int")).alias("order_ids"),
        F.struct(*[F.col(s).cast("int").alias(n) for s, n in (("mn", "min"), ("mx", "max"), ("av", "avg"), ("tot", "total"))])
        .alias("order_value"),
    )


def _loyalty_back(spark, d):
    path = scratch_path(spark, "loyalty")
    D.write_nested_delimited(_loyalty(spark, d), path, field="|", item=",", key=":")
    return D.read_nested_delimited(spark, path, LOYALTY, field="|", item=",", key=":")


@register("src_nested", f"select cust_id, fname, lname, email, level from ({_LOYALTY_SQL})")
def src_nested(spark, d):
    return _loyalty_back(spark, d).select("cust_id", "fname", "lname", "email", "level")


@register("nested_map", f"select cust_id, home_phone from ({_LOYALTY_SQL})")
def nested_map(spark, d):
    return _loyalty_back(spark, d).select("cust_id", F.try_element_at("phone", F.lit("HOME")).alias("home_phone"))


@register("nested_array", f"select cust_id, order_id_2 from ({_LOYALTY_SQL})")
def nested_array(spark, d):
    return _loyalty_back(spark, d).select("cust_id", F.get("order_ids", 2).alias("order_id_2"))


@register("nested_struct", f"select cust_id, total from ({_LOYALTY_SQL})")
def nested_struct(spark, d):
    return _loyalty_back(spark, d).select("cust_id", F.col("order_value.total").alias("total"))


_INTS = T.ArrayType(T.IntegerType())
NESTED = T.StructType([
    T.StructField("cust_id", T.IntegerType()),
    T.StructField("visits", T.ArrayType(T.StructType([
        T.StructField("day", T.IntegerType()), T.StructField("pages", T.ArrayType(T.StringType()))]))),
    T.StructField("limits", T.MapType(T.StringType(), _INTS)),
    T.StructField("last", T.StructType([T.StructField("codes", _INTS)])),
])


def _nested_rows(spark, d):
    """Customers with arrays of structs, maps of arrays and a struct of one array, in which
    values, members and whole collections are null or empty, by the customer's number."""
    key = F.col("c_custkey").cast("int")
    none = F.lit(None)
    kinds = {f.name: f.dataType for f in NESTED.fields}
    visit = kinds["visits"].elementType

    def day(n, pages):
        return F.struct(n.cast("int").alias("day"), pages.cast("array<string>").alias("pages")).cast(visit)

    def ints(*values):
        return F.array(*values).cast("array<int>")

    pages = F.array(F.col("c_mktsegment"), none.cast("string"), F.lit(""))
    visits = (F.when(key % 5 == 1, F.array().cast(kinds["visits"]))
              .when(key % 5 == 2, F.array(day(key, pages), none.cast(visit), day(none, F.array())))
              .when(key % 5 == 3, F.array(day(key, none)))
              .when(key % 5 == 4, F.array(none.cast(visit))))
    limits = (F.when(key % 4 == 1, F.create_map().cast(kinds["limits"]))
              .when(key % 4 == 2, F.create_map(F.lit("a"), ints(key, none), F.lit("b"), none.cast("array<int>")))
              .when(key % 4 == 3, F.create_map(F.lit("c"), ints())))
    last = (F.when(key % 3 == 1, F.struct(none.cast("array<int>").alias("codes")))
            .when(key % 3 == 2, F.struct(F.when(key % 2 == 0, ints()).otherwise(ints(none)).alias("codes"))))
    return V.table(spark, d, "customer").select(key.alias("cust_id"), visits.alias("visits"), limits.alias("limits"), last.alias("last"))


@register("nested_deep", """select k as cust_id,
  case k % 5 when 1 then 0 when 2 then 3 when 3 then 1 when 4 then 1 end::int as n_visits,
  case when k % 5 in (1, 3) then 0 when k % 5 in (2, 4) then 1 end::int as null_visits,
  case when k % 5 in (2, 3) then k end as first_day,
  case when k % 5 = 2 then 3 end::int as n_pages, case when k % 5 = 2 then c_mktsegment end as first_page,
  case when k % 5 = 2 then 1 end::int as null_pages, case when k % 5 = 2 then '' end as last_page,
  case when k % 5 = 2 then 0 end::int as third_pages,
  case k % 4 when 1 then 0 when 2 then 2 when 3 then 1 end::int as n_limits,
  case when k % 4 = 2 then k end as a_first, case when k % 4 = 2 then 2 end::int as n_a,
  case when k % 4 = 2 then true when k % 4 <> 0 then false end as b_null, case when k % 4 = 3 then 0 end::int as n_c,
  k % 3 = 0 as last_null, case when k % 3 = 2 then k % 2 end::int as n_codes
from (select c_custkey::int as k, c_mktsegment from customer)""")
def nested_deep(spark, d):
    """Written and read back; what the nested columns hold, in flat columns."""
    path = scratch_path(spark, "nested_deep")
    D.write_nested_delimited(_nested_rows(spark, d), path)
    back = D.read_nested_delimited(spark, path, NESTED)
    visits, limits, first = F.col("visits"), F.col("limits"), F.get("visits", 0)
    size = {c: F.when(F.col(c).isNotNull(), F.size(c)) for c in ("visits", "limits")}

    def n(c):
        return F.when(c.isNotNull(), F.size(c))

    def nulls(c):
        return F.when(c.isNotNull(), F.size(F.filter(c, lambda x: x.isNull())))

    a = F.try_element_at(limits, F.lit("a"))
    return back.select(
        "cust_id", size["visits"].alias("n_visits"), nulls(visits).alias("null_visits"), first["day"].alias("first_day"),
        n(first["pages"]).alias("n_pages"), F.get(first["pages"], 0).alias("first_page"), nulls(first["pages"]).alias("null_pages"),
        F.get(first["pages"], 2).alias("last_page"), n(F.get("visits", 2)["pages"]).alias("third_pages"),
        size["limits"].alias("n_limits"), F.get(a, 0).alias("a_first"), n(a).alias("n_a"),
        (F.map_contains_key(limits, "b") & F.try_element_at(limits, F.lit("b")).isNull()).alias("b_null"),
        n(F.try_element_at(limits, F.lit("c"))).alias("n_c"), F.col("last").isNull().alias("last_null"), n(F.col("last.codes")).alias("n_codes"))


# ---- catalog tables ------------------------------------------------------------------------

@register("tbl_external", W("select job_title, count(*) as num from employees group by job_title", "employees"))
def tbl_external(spark, d):
    loc = scratch_path(spark, "employees_ext")
    D.write_delimited(V.employees(spark, d), loc, sep="\t")
    name = f"employees_{_uid()}"
    t = TB.create_external_table(spark, name, T._parse_datatype_string(EMP), loc, sep="\t")
    return t.groupBy("job_title").agg(F.count(F.lit(1)).alias("num"))


def _typed_ratings(spark, d):
    r = V.ratings(spark, d)
    return r.select(
        F.timestamp_add("MINUTE", F.col("post_id"), F.lit("2012-01-01 00:00:00").cast("timestamp_ntz")).alias("posted"),
        F.col("post_id").cast("int").alias("cust_id"),
        F.substring("prod_id", 4, 8).cast("int").alias("prod_id"),
        F.col("rating").cast("tinyint").alias("rating"),
        F.col("message"),
    )


_TYPED_RATINGS_SQL = """select timestamp '2012-01-01 00:00:00' + to_minutes(post_id) as posted, cast(post_id as int) as cust_id,
  cast(substring(prod_id, 4, 8) as int) as prod_id, cast(rating as tinyint) as rating, message from ratings"""


@register("tbl_managed", W(f"select * from ({_TYPED_RATINGS_SQL})", "ratings"))
def tbl_managed(spark, d):
    name = f"ratings_{_uid()}"
    TB.create_typed_table(spark, name, _typed_ratings(spark, d), scratch_path(spark, name))
    return spark.table(name)


@register("tbl_append", W("""select count(*) filter (where post_id % 2 = 0) as n_before, count(*) as n_after
from ratings""", "ratings"))
def tbl_append(spark, d):
    """Load the first file into a typed table, then append the second (``LOAD DATA``)."""
    rows = _typed_ratings(spark, d)
    name = f"ratings_{_uid()}"
    TB.create_typed_table(spark, name, rows.filter(F.col("cust_id") % 2 == 0), scratch_path(spark, name))
    before = spark.table(name).count()
    TB.append_into(spark, name, rows.filter(F.col("cust_id") % 2 == 1))
    return spark.table(name).agg(F.lit(before).cast("bigint").alias("n_before"),
                                 F.count(F.lit(1)).alias("n_after"))


@register("tbl_load_files", W("""select count(*) filter (where post_id % 3 = 0) as n_before, count(*) as n_after,
  cast(sum(post_id) as bigint) as ids, cast(0 as bigint) as n_left from ratings""", "ratings"))
def tbl_load_files(spark, d):
    """``LOAD DATA INPATH``: two folders' files are moved into a table, and none is left."""
    rows = _typed_ratings(spark, d)
    name = f"ratings_{_uid()}"
    TB.create_typed_table(spark, name, rows.filter(F.col("cust_id") % 3 == 0), scratch_path(spark, name))
    before = spark.table(name).count()
    left = 0
    for part in (1, 2):
        folder = scratch_path(spark, f"incoming_{part}")
        rows.filter(F.col("cust_id") % 3 == part).write.parquet(folder)
        TB.load_files(spark, name, folder)
        left += len(FS.data_files(spark, folder))
    return spark.table(name).agg(F.lit(before).cast("bigint").alias("n_before"), F.count(F.lit(1)).alias("n_after"),
                                 F.sum(F.col("cust_id").cast("bigint")).alias("ids"), F.lit(left).cast("bigint").alias("n_left"))


@register("tbl_rename_column", W("select emp_id, job_title as title from employees", "employees"))
def tbl_rename_column(spark, d):
    """Rename a column, then the table (``CHANGE level status`` / ``RENAME TO``)."""
    name = f"loyalty_{_uid()}"
    TB.create_typed_table(spark, name, V.employees(spark, d), scratch_path(spark, name))
    TB.rename_column(spark, name, "job_title", "title", scratch_path(spark, name + "_v2"))
    new = f"reward_{_uid()}"
    TB.rename_table(spark, name, new)
    return spark.table(new).select("emp_id", "title")


# ---- sinks ---------------------------------------------------------------------------------

_WORDS_SQL = r"select unnest(string_split_regex(text, '[^\p{L}\p{N}\p{M}_]')) as word from documents"


@register("sink_roundtrip", f"select word, count(*) as count from ({_WORDS_SQL}) group by word")
def sink_roundtrip(spark, d):
    """Word counts written twice to one folder (the second run replaces the first),
    plus the top 10 as a single file; both read back."""
    counts = TX.word_count(V.table(spark, d, "documents"), "text")
    path = scratch_path(spark, "word_count")
    counts.select(F.concat("word", F.lit("?")).alias("word"), "count").write.mode("overwrite").parquet(path)
    counts.write.mode("overwrite").parquet(path)
    top = scratch_path(spark, "word_top")
    R.top_k(spark.read.parquet(path), 10, F.col("count").desc(), F.col("word").asc()).coalesce(1).write.mode("overwrite").parquet(top)
    if spark.read.parquet(top).count() != min(10, spark.read.parquet(path).count()):
        raise RuntimeError("single-file sink lost rows")
    return spark.read.parquet(path)


@register("sink_kv_text", f"select word || ': ' || cast(count(*) as varchar) as value from ({_WORDS_SQL}) group by word")
def sink_kv_text(spark, d):
    counts = TX.word_count(V.table(spark, d, "documents"), "text")
    path = scratch_path(spark, "word_count_txt")
    TX.kv_lines(counts, "word", "count").write.mode("overwrite").text(path)
    return L.read_text_lines(spark, path)
