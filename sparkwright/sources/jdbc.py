"""JDBC sources.

Not exercised by the tests: this container has no database server, and
starting one (even embedded) is out of scope. The calls are the standard
``DataFrameReader.jdbc`` options; credentials always come from the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, properties: dict[str, str],
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int | None = None,
               fetch_size: int = 10_000, one_task: bool = False) -> DataFrame:
    """Table scan by ``num_partitions`` tasks over disjoint ranges of the
    numeric ``partition_column``. All four must be given, unless ``one_task``
    says that the table is small enough for a single reader."""
    if not one_task and None in (partition_column, lower, upper, num_partitions):
        raise ValueError("name partition_column, lower, upper and num_partitions, or one_task")
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("fetchsize", fetch_size))
    for k, v in properties.items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower).option("upperBound", upper)
                  .option("numPartitions", num_partitions))
    return reader.load()


def read_query(spark: SparkSession, url: str, sql: str, properties: dict[str, str]) -> DataFrame:
    """The remote engine evaluates ``sql``; Spark reads its result."""
    reader = spark.read.format("jdbc").option("url", url).option("query", sql)
    for k, v in properties.items():
        reader = reader.option(k, v)
    return reader.load()
