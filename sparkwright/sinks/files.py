"""Sinks (K1-K6, K8, K9, K13).

Writers are plain ``DataFrameWriter`` calls; Spark commits output with its
task/job commit protocol, so a retried task never leaves partial files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.functions.columns import joined_fields
from sparkwright.functions.marker import marker_encode


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None) -> None:
    """K1."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_orc(df: DataFrame, path: str, mode: str = "append") -> None:
    """K2."""
    df.write.mode(mode).orc(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", sep: str = ",",
              header: bool = False) -> None:
    """K3: default mode refuses an existing path; give each result its own path."""
    df.write.mode(mode).option("sep", sep).option("header", header).format("csv").save(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_text(df: DataFrame, path: str, col: str = "value", mode: str = "overwrite") -> None:
    """One line per row from a single string column."""
    df.select(F.col(col).alias("value")).write.mode(mode).option("lineSep", "\n").text(path)


def write_keyed_text(df: DataFrame, path: str, key: str, value_cols: Sequence[str],
                     num_files: int, sep: str = "\t") -> None:
    """K5: MapReduce-style output: ``num_files`` files hash-partitioned by key,
    each sorted by key, lines ``key<sep>v1<sep>v2``; the output dir is
    replaced. A null is an empty field."""
    (df.repartition(num_files, key).sortWithinPartitions(key)
     .select(joined_fields(sep, [F.col(key), *map(F.col, value_cols)]).alias("value"))
     .write.mode("overwrite").option("lineSep", "\n").text(path))


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str],
               mode: str = "append", num_partitions: int | None = None) -> None:
    """K6: JDBC append. ``num_partitions`` bounds concurrent connections.
    Credentials come from the caller, never from code.

    The bound is a ``repartition``, not a ``coalesce``: a coalesce would also
    shrink the upstream stage to that many tasks, while a shuffle keeps the
    computation fully parallel and limits only the writing tasks.
    """
    out = df.repartition(num_partitions) if num_partitions else df
    out.write.mode(mode).jdbc(url, table, properties=properties)


def write_marker_text(df: DataFrame, path: str, col: str = "value",
                      gap: int | None = None, mode: str = "overwrite") -> None:
    """K8: marker-text file (see ``functions.marker``)."""
    df.select(marker_encode(col, gap).alias("value")).write.mode(mode).option(
        "lineSep", "\n").text(path)


def write_repartitioned(df: DataFrame, path: str, keys: Sequence[str],
                        num_partitions: int | None = None, fmt: str = "parquet",
                        mode: str = "overwrite") -> None:
    """K9: controlled repartition before an insert.

    With ``num_partitions`` the data is hash-partitioned into that many
    files by ``keys``; without it, a ``REBALANCE`` on the keys lets AQE pick
    file sizes and split skewed keys.
    """
    if num_partitions:
        out = df.repartition(num_partitions, *keys)
    else:
        out = df.hint("rebalance", *keys)
    out.write.mode(mode).format(fmt).save(path)


def show(df: DataFrame, n: int = 20, truncate: bool = True) -> DataFrame:
    """Print the first rows; returns the DataFrame for chaining."""
    df.show(n, truncate)
    return df
