"""Adapters from the driver tables to the reference's input record types.

Each adapter is a lazy projection of a driver table, so every query that uses
it still scans the whole table and its work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.sources.files import table

# Thresholds scaled to the fixture's order years (1995-2001).
LOTTERY_YEAR = "1998"
LOTTERY_SINCE = "199601"


def lottery_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """apply(batchNum yyyyMM string, carNum string): one row per order."""
    return table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyyMM").alias("batchNum"),
        F.col("o_custkey").cast("string").alias("carNum"))


def lottery_lucky(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lucky(batchNum, carNum): per customer, the first month with an F order."""
    # Grouped on carNum itself (not o_custkey), so the result is already
    # hash-partitioned on the key every lottery join and count uses.
    return (table(spark, sf_dir, "orders")
            .filter(F.col("o_orderstatus") == "F")
            .groupBy(F.col("o_custkey").cast("string").alias("carNum"))
            .agg(F.date_format(F.min("o_orderdate"), "yyyyMM").alias("batchNum"))
            .select("batchNum", "carNum"))


def lottery_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return lottery_apply(spark, sf_dir), lottery_lucky(spark, sf_dir)


# DuckDB views matching the two adapters, for the oracle SQL.
LOTTERY_SQL_CTE = """
apply AS (
  SELECT strftime(o_orderdate, '%Y%m') AS batchNum, CAST(o_custkey AS VARCHAR) AS carNum
  FROM orders),
lucky AS (
  SELECT min(strftime(o_orderdate, '%Y%m')) AS batchNum, CAST(o_custkey AS VARCHAR) AS carNum
  FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)
"""
