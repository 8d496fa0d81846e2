"""Input parallelism for CPU-heavy row expansion.

A scan gives one task per file split; a file with a single large row group
is one split however many cores there are. Before a heavy per-row step (e.g.
splitting whole documents into words) ``spread`` hash-partitions the rows
over the cluster's cores - but only when the scan has fewer partitions than
that. A large input already has thousands of splits, so there it is a no-op
and adds no shuffle.

Use it only where each partition holds many rows (a table whose row groups
hold many documents). Where one row is one whole file, spreading cannot
split a row's work and would only move the data, so operators leave their
input as partitioned and the caller decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, keys: Sequence[str] = (), min_partitions: int | None = None) -> DataFrame:
    """Hash-partition ``df`` by ``keys`` to at least ``min_partitions``
    (default: the default parallelism) if it has fewer partitions.

    Without keys the hash of the whole row is used: deterministic on retry,
    and unlike a round-robin repartition it needs no local sort first.
    """
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    by = [F.col(k) for k in keys] or [F.xxhash64(*[F.col(c) for c in df.columns])]
    return df.repartition(target, *by)
