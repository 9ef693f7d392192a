"""Database table import (the reference's sqoop step): a partitioned JDBC read written
into a table. Not exercised by the tests or registered queries: checking it needs a
running database, and this build starts none."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc_table(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
                    partition_column: str | None = None, lower_bound: int | None = None,
                    upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Read a database table. With ``partition_column`` and its bounds the read is split
    into ``num_partitions`` range queries that run in parallel on the executors; without
    them the whole table comes through one task, so give them for large tables."""
    props = dict(properties or {})
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a partitioned read needs lower_bound, upper_bound and num_partitions")
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(url, table, properties=props)


def import_table(spark: SparkSession, url: str, table: str, target: str, location: str, sep: str = "\t",
                 **read_args) -> DataFrame:
    """Import a database table as a tab-delimited table at ``location`` (``--hive-import``
    with ``--fields-terminated-by '\\t'``) and return it."""
    df = read_jdbc_table(spark, url, table, **read_args)
    (df.write.format("csv").option("sep", sep).option("path", location).saveAsTable(target))
    return spark.table(target)
