"""Catalog tables: external tables over delimited folders, typed tables, appends,
renames, describe and drop. Works on Spark's session catalog without Hive support.

Table data always lives in a folder the caller gives (normally under the shared
checkpoint folder), never in a machine-local default warehouse.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sparkmine.sources.delimited import NULL, regex_quote
from sparkmine.sources.files import move_files


LINES = "__lines"  # the table of lines behind an external table's view


def create_external_table(spark: SparkSession, name: str, schema: T.StructType, location: str, sep: str = "\t") -> DataFrame:
    """Hive's ``ROW FORMAT DELIMITED .. STORED AS TEXTFILE LOCATION``: an external table of
    the folder's lines and a view that cuts and types them (see ``delimited``). Both are
    permanent, and ``drop_table`` keeps the files."""
    spark.sql(f"CREATE TABLE {name}{LINES} (value STRING) USING text LOCATION '{location}'")

    def text(s: str) -> str:
        return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"

    parts = f"split(value, {text(regex_quote(sep))}, -1)"
    columns = []
    for i, f in enumerate(schema.fields):
        one = f"nullif(get({parts}, {i}), {text(NULL)})"
        if not isinstance(f.dataType, T.StringType):
            one = f"try_cast(if({one} = trim({one}), {one}, null) as {f.dataType.simpleString()})"
        columns.append(f"{one} as `{f.name}`")
    spark.sql(f"CREATE VIEW {name} AS SELECT {', '.join(columns)} FROM {name}{LINES}")
    return spark.table(name)


def create_typed_table(spark: SparkSession, name: str, df: DataFrame, location: str,
                       fmt: str = "parquet") -> DataFrame:
    """A typed table (any of timestamp, int, tinyint, string, ...) stored at ``location``."""
    df.write.format(fmt).option("path", location).saveAsTable(name)
    return spark.table(name)


def append_into(spark: SparkSession, name: str, df: DataFrame) -> None:
    """``INSERT INTO``: append rows, matched by position."""
    df.write.insertInto(name)


def table_location(spark: SparkSession, name: str) -> str:
    """The folder of a table's files (of an external table: of its lines)."""
    base = name + LINES if spark.catalog.tableExists(name + LINES) else name
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {base}").filter("col_name = 'Location'").first()
    return row["data_type"]


def load_files(spark: SparkSession, name: str, source: str, overwrite: bool = False) -> list[str]:
    """``LOAD DATA INPATH source [OVERWRITE] INTO TABLE name``: the files of ``source`` (a
    folder or one file, in the table's format) are moved into the table's folder; no row
    is read or written. Their new names: see ``files.move_files``."""
    names = move_files(spark, source, table_location(spark, name), overwrite)
    spark.catalog.refreshTable(name + LINES if spark.catalog.tableExists(name + LINES) else name)
    return names


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {name}")


def show_tables(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW TABLES")


def rename_table(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")


def drop_table(spark: SparkSession, name: str) -> None:
    if spark.catalog.tableExists(name + LINES):
        spark.sql(f"DROP VIEW IF EXISTS {name}")
        spark.sql(f"DROP TABLE {name}{LINES}")
        return
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def rename_column(spark: SparkSession, name: str, old: str, new: str, location: str,
                  fmt: str = "parquet") -> DataFrame:
    """``ALTER TABLE .. CHANGE old new``: the session catalog refuses column renames on
    datasource tables, so write the renamed table to ``location``, drop the old one and
    give the new one the old name."""
    tmp = f"{name}__renamed"
    src = spark.table(name).withColumnRenamed(old, new)
    create_typed_table(spark, tmp, src, location, fmt)
    drop_table(spark, name)
    rename_table(spark, tmp, name)
    return spark.table(name)
