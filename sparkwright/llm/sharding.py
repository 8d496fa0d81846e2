"""Contiguous balanced shards from global byte-size prefix sums.

Rows are range-partitioned in their order, each partition reports one total,
the totals' running sum (one row per partition) gives each partition's start,
and a window inside each partition gives each row's byte and row offset.
Equal cuts of the byte axis are the shards. No step sees more than one range
partition's narrow rows in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkwright.llm.common import materialise


def prefix_sums(rows: DataFrame, order: Sequence[str], size: str) -> DataFrame:
    """``rows`` with ``before`` (sizes of all earlier rows), ``row_number``
    (0-based) and ``total`` (the sum over all rows).

    Earlier means first in ``order`` (ascending, nulls last). Rows equal in all
    of ``order`` follow each other in either order. ``rows`` must not have
    columns of those names or ``_part``. An empty input gives no rows.
    """
    by = [F.col(c).asc_nulls_last() for c in order]
    placed = materialise(
        rows.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()), "prefix")
    parts = placed.groupBy("_part").agg(F.sum(size).alias("_bytes"), F.count("*").alias("_rows"))
    # One row per partition: the number of partitions bounds this window and the broadcast.
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(ahead), F.lit(0)).alias("_start"),
        F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_first"),
        F.sum("_bytes").over(Window.partitionBy()).alias("total"))
    here = Window.partitionBy("_part").orderBy(*by).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (placed
            .withColumn("_upto", F.sum(size).over(here))
            .withColumn("_nth", F.count(F.lit(1)).over(here))
            .join(F.broadcast(starts), "_part")
            .withColumn("before", F.col("_start") + F.col("_upto") - F.col(size))
            .withColumn("row_number", F.col("_first") + F.col("_nth") - 1)
            .drop("_part", "_upto", "_nth", "_start", "_first"))


def balanced_shards(rows: DataFrame, order: Sequence[str], size: str,
                    n_shards: int) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``n_shards - 1``) and ``slot``.

    A row belongs to the shard in which the middle of its bytes falls, so a
    shard misses its equal share by at most half a row at either end. Shards
    are contiguous in ``order``; ``slot`` counts a shard's rows from 0 without
    gaps. If all sizes are 0 every row is in shard 0. A row larger than a share
    may leave a neighbouring shard empty.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    placed = materialise(
        prefix_sums(rows, order, size).withColumn(
            "shard",
            F.expr(f"cast(coalesce(least({n_shards - 1}, ((2 * before + {size}) * {n_shards})"
                   " div nullif(2 * total, 0)), 0) as int)")), "shards")
    # n_shards rows: the number of shards bounds this broadcast.
    first = placed.groupBy("shard").agg(F.min("row_number").alias("_first"))
    return (placed.join(F.broadcast(first), "shard")
            .withColumn("slot", F.col("row_number") - F.col("_first"))
            .drop("before", "row_number", "total", "_first"))


def shard_documents(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """Document shards by text bytes: doc_id, size, text_crc32, law, shard,
    slot, grown_shard.

    ``size`` is the text's UTF-8 bytes plus 8; a null text counts as empty
    (crc32 0). The order is doc_id (nulls last), then crc32 and size, so equal
    ids and repeated rows have a fixed place. Other columns are not read.
    """
    rows = materialise(docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32")),
        "sizes")
    return (balanced_shards(rows, ["doc_id", "text_crc32", "size"], "size", n_shards)
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))


# DuckDB has no crc32: its table from the polynomial, then one step per byte.
ORACLE_SQL = """
WITH tb AS (
  SELECT list_transform(range(256), lambda n: list_reduce(
    list_prepend(n, range(8)),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tb),
b AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size, list_prepend(
    CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                                               lambda x: CAST('0x' || x AS BIGINT))) AS bs
  FROM documents),
d AS (
  SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(xor(4294967295, list_reduce(
    bs, lambda c, x: xor(tb[CAST(1 + xor(c, x) % 256 AS BIGINT)], c >> 8))) AS BIGINT) AS crc
  FROM b, tb),
o AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id NULLS LAST, crc, size ROWS UNBOUNDED PRECEDING) AS upto,
         sum(size) OVER () AS total FROM d),
s AS (SELECT *, CAST(least(23, (2 * upto - size) * 24 // (2 * total)) AS INTEGER) AS shard FROM o)
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS LAST, crc, size) - 1 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM s
"""
