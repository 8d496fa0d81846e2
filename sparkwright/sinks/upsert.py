"""Keyed upsert (K7, K10): latest write wins per key.

Where a table format or database holds the target, ``MergeSink`` hands every
micro-batch to the caller's MERGE (for example ``DeltaTable.merge`` or a staged
JDBC upsert), keyed by batch id so the caller can make it idempotent.

``KeyedUpsertSink`` keeps the target itself as plain Parquet: one row per key,
in buckets by key hash. A micro-batch is written down first, then the buckets it
touches are merged with their current rows and written as ``batch=<n>/bucket=<b>``,
and a marker commits the batch. A bucket's current rows are those of its highest
committed batch, so readers see a batch whole or not at all: a write that died
half way has no marker, is ignored, and is replaced when the batch is replayed.
What a commit supersedes is deleted afterwards, so the folder holds one row per
key however many batches came.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_per_key(df: DataFrame, keys: Sequence[str], version: str,
                   values: Sequence[str]) -> DataFrame:
    """Per key, the values of the row with the highest ``version``."""
    latest = F.max_by(F.struct(*[F.col(v) for v in values]), F.col(version))
    return (df.groupBy(*keys).agg(latest.alias("_v"), F.max(version).alias(version))
            .select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values], version))


class MergeSink:
    """``foreachBatch`` target that calls ``merge(batch, batch_id)`` with one
    row per key (the last of the batch by ``order``, if rows can repeat a key)."""

    def __init__(self, merge: Callable[[DataFrame, int], None], keys: Sequence[str],
                 order: str | None = None):
        self.merge, self.keys, self.order = merge, list(keys), order

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.order is not None:
            values = [c for c in batch.columns if c not in self.keys and c != self.order]
            batch = latest_per_key(batch, self.keys, self.order, values).select(batch.columns)
        self.merge(batch, batch_id)


class KeyedUpsertSink:
    """``foreachBatch`` target with upsert semantics on ``keys``.

    A batch has at most one row per key (an update-mode aggregate gives that);
    of more, one wins. ``buckets`` is fixed when the folder is new: choose it so
    that one bucket's rows suit one task, because a touched bucket is rewritten
    whole. It may also be a never-null integer expression over ``keys``. One folder belongs to one stream: batch ids count from its start, and
    a batch that is already committed is skipped.
    """

    def __init__(self, path: str, keys: Sequence[str], buckets: int | Column = 16):
        self.path, self.keys, self.buckets = path.rstrip("/"), list(keys), buckets

    def _fs(self, spark: SparkSession):
        path = spark._jvm.org.apache.hadoop.fs.Path
        return path(self.path).getFileSystem(spark._jsc.hadoopConfiguration()), path

    def _numbers(self, spark: SparkSession, folder: str, prefix: str) -> list[int]:
        """n of each entry ``<prefix>n`` of a folder; none if it isn't there."""
        fs, path = self._fs(spark)
        top = path(folder)
        names = [f.getPath().getName() for f in fs.listStatus(top)] if fs.exists(top) else []
        return sorted(int(x[len(prefix):]) for x in names if x.startswith(prefix))

    def _live(self, spark: SparkSession) -> dict[int, int]:
        """Each bucket's highest committed batch. Two folder names per bucket at
        most are read: superseded ones go after each commit."""
        done = set(self._numbers(spark, f"{self.path}/committed", "batch="))
        live = {}
        for n in self._numbers(spark, f"{self.path}/data", "batch="):
            if n in done:
                live |= {b: n for b in self._numbers(spark, f"{self.path}/data/batch={n}", "bucket=")}
        return live

    def _folder(self, batch_id: int, bucket: int) -> str:
        return f"{self.path}/data/batch={batch_id}/bucket={bucket}"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fs, path = self._fs(spark)
        if {"bucket", "_new"} & {c.lower() for c in batch.columns}:
            raise ValueError("columns bucket and _new are the sink's own")
        if batch_id <= max(self._numbers(spark, f"{self.path}/committed", "batch="), default=-1):
            return  # a replay of a committed batch
        bucket = (self.buckets if isinstance(self.buckets, Column) else
                  F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets))).cast("int")
        staged = f"{self.path}/staged"
        batch.withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(staged)
        touched, live = self._numbers(spark, staged, "bucket="), self._live(spark)
        if touched:
            rows = spark.read.schema(T.StructType(
                [*batch.schema, T.StructField("bucket", T.IntegerType())])).parquet(staged).withColumn(
                "_new", F.lit(1))
            old = [self._folder(live[b], b) for b in touched if b in live]
            if old:
                before = spark.read.schema(batch.schema).parquet(*old)
                rows = rows.unionByName(before.withColumn("bucket", bucket).withColumn("_new", F.lit(0)))
            values = [c for c in batch.columns if c not in self.keys]
            merged = latest_per_key(rows, ["bucket", *self.keys], "_new", values).drop("_new")
            # One task and one file per touched bucket.
            (merged.repartition(len(touched), "bucket").write.mode("overwrite")
             .partitionBy("bucket").parquet(f"{self.path}/data/batch={batch_id}"))
        fs.mkdirs(path(f"{self.path}/committed/batch={batch_id}"))
        self._clean(spark, batch_id)

    def _clean(self, spark: SparkSession, last: int) -> None:
        """Delete what ``last`` supersedes; what an earlier crash left goes too."""
        fs, path = self._fs(spark)
        live = self._live(spark)
        for n in self._numbers(spark, f"{self.path}/data", "batch="):
            here = self._numbers(spark, f"{self.path}/data/batch={n}", "bucket=")
            stale = [b for b in here if n < live.get(b, n)]
            for b in stale:
                fs.delete(path(self._folder(n, b)), True)
            if len(stale) == len(here) and n <= last:
                fs.delete(path(f"{self.path}/data/batch={n}"), True)
        kept = set(live.values()) | {last}
        for n in self._numbers(spark, f"{self.path}/committed", "batch="):
            if n not in kept:
                fs.delete(path(f"{self.path}/committed/batch={n}"), True)
        fs.delete(path(f"{self.path}/staged"), True)

    def resolve(self, spark: SparkSession, schema=None) -> DataFrame:
        """The table: one row per key. ``schema`` is needed while it has no rows."""
        folders = [self._folder(n, b) for b, n in sorted(self._live(spark).items())]
        if not folders:
            return spark.createDataFrame([], schema)
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(*folders)
