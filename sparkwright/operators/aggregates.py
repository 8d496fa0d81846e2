"""Multi-level aggregations (A1-A12, A20-A22) as DataFrame -> DataFrame functions.

Every aggregation here is a declarative ``groupBy().agg()`` so Spark plans a
partial (map-side) aggregate before the shuffle: a hot key costs one partial
row per map task, not one row per input record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def row_count(df: DataFrame, alias: str = "n") -> DataFrame:
    """A1: one-row count."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def distinct_rows(df: DataFrame, cols: str | Sequence[str] | None = None) -> DataFrame:
    """A3/A4: distinct values or distinct rows over the given columns."""
    return (df if cols is None else df.select(*_cols(cols))).distinct()


def count_by(df: DataFrame, keys: str | Sequence[str], alias: str = "count") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias(alias))


def frequency_histogram(df: DataFrame, key: str, x_name: str = "x_axis",
                        y_name: str = "y_axis") -> DataFrame:
    """Count per ``key``, then how many keys share each count."""
    per_key = count_by(df, key, x_name)
    return count_by(per_key, x_name, y_name)


def max_count_histogram(df: DataFrame, group: Sequence[str], entity: str,
                        value_name: str = "multiplier", count_name: str = "cnt") -> DataFrame:
    """Count per ``group``, max of that count per ``entity``, then histogram."""
    per_group = count_by(df, list(group), value_name)
    per_entity = per_group.groupBy(entity).agg(F.max(value_name).alias(value_name))
    return count_by(per_entity, value_name, count_name)


def sum_by_key(df: DataFrame, key: str | Sequence[str], value: str | Column,
               alias: str = "total", num_partitions: int | None = None) -> DataFrame:
    """``reduceByKey(_ + _, n)``: sum per key with a chosen output partitioning."""
    val = F.col(value) if isinstance(value, str) else value
    out = df.groupBy(*_cols(key)).agg(F.sum(val).alias(alias))
    if num_partitions:
        out = out.repartition(num_partitions, *_cols(key))
    return out


def global_stats(df: DataFrame, col: str) -> DataFrame:
    """A2: max, min, mean, sum and count of one column (empty input -> nulls)."""
    c = F.col(col)
    return df.agg(F.max(c).alias("max_v"), F.min(c).alias("min_v"),
                  F.avg(c).alias("mean_v"), F.sum(c).alias("sum_v"),
                  F.count(c).alias("count_v"))


def product_by(df: DataFrame, keys: str | Sequence[str], value: str | Column,
               alias: str = "product") -> DataFrame:
    """Product of a column per group (double result)."""
    val = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*_cols(keys)).agg(F.product(val).alias(alias))


def array_product(arr: Column) -> Column:
    """A22 over an array column: left fold with multiplication."""
    return F.aggregate(arr, F.lit(1.0).cast("double"), lambda acc, x: acc * x)


def group_by_expr(df: DataFrame, key_expr: Column, key_name: str,
                  *aggs: Column) -> DataFrame:
    """Group by a computed key (the typed ``groupByKey`` of the reference)."""
    return df.groupBy(key_expr.alias(key_name)).agg(*aggs)
