"""Changelog of the hourly spend report (T2, T4): insert and update rows.

``transformWithState`` keeps one total per (account, hour). Every micro-batch
that touches such a pair gives, like an updating table of a stream processor, an
insert (``+I``) for a new pair or a retraction and its replacement (``-U``, ``+U``)
for a known one. An event-time timer drops an hour's totals when the watermark has
passed its end, so the state holds the pairs of the last hours only: the
watermark's delay is the parameter that bounds it. Rows behind the watermark
are dropped by Spark, never counted twice as new inserts.

Each call of the processor costs a few round trips to the state store, so a call
takes many accounts: the state's key is an hour and one of ``buckets`` hash buckets
of its accounts, its value the list of their totals. One bucket of one hour is what a
task holds at a time, and what a micro-batch that touches it reads and writes.

Adding the amounts of ``+I`` and ``+U`` and taking off those of ``-U`` gives the
report, in any order of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

INSERT, BEFORE, AFTER = "+I", "-U", "+U"
HOUR_MS = 3_600_000

# Buckets of an hour's accounts; a checkpoint must go on with the number it began with.
BUCKETS = 64

# Types, not a DDL string: workers import this module without a session.
_TOTAL = T.StructType([T.StructField("account", T.StringType()), T.StructField("amount", T.LongType())])
# Accounts and hours are never null in the state: "n", or "v" and the account; NO_HOUR for a row without a time.
NO_HOUR = -(1 << 62)
_CHANGES = T.StructType([
    T.StructField("account", T.StringType()), T.StructField("hour", T.LongType()),
    T.StructField("kind", T.StringType()), T.StructField("amount", T.LongType())])


class HourlyTotals(StatefulProcessor):
    """The totals of one hour's accounts of one bucket."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._total = handle.getListState("total", _TOTAL)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        hour, added = int(key[0]), {}
        for r in rows:
            for account, amount in zip(r["account"].tolist(), r["amount"].tolist()):
                added[account] = added.get(account, 0) + amount
        totals = dict(self._total.get())
        if not totals and hour != NO_HOUR:
            self._handle.registerTimer(hour * 1000 + HOUR_MS)
        changes = []
        for account, amount in added.items():
            before = totals.get(account)
            if before is None:
                changes.append((account, hour, INSERT, amount))
                totals[account] = amount
            else:
                changes += [(account, hour, BEFORE, before), (account, hour, AFTER, before + amount)]
                totals[account] = before + amount
        self._total.put(list(totals.items()))
        yield pd.DataFrame(changes, columns=_CHANGES.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._total.clear()
        return iter(())

    def close(self) -> None:
        pass


def changes(transactions: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(account_id, log_ts, kind, amount): the report's changes. ``transactions``
    is a stream with a watermark on ``transaction_time``. Null accounts, times and
    amounts are an account, an hour and 0."""
    hour = F.unix_seconds(F.date_trunc("hour", "transaction_time"))
    kind = transactions.schema["account_id"].dataType
    keyed = transactions.select(
        F.coalesce(F.concat(F.lit("v"), F.col("account_id").cast("string")), F.lit("n")).alias("account"),
        F.coalesce(hour, F.lit(NO_HOUR).cast("long")).alias("hour"),
        F.coalesce(F.col("amount"), F.lit(0)).cast("long").alias("amount"), "transaction_time")
    bucket = F.pmod(F.xxhash64("account"), F.lit(buckets)).cast("int")
    out = keyed.withColumn("bucket", bucket).groupBy("hour", "bucket").transformWithStateInPandas(
        HourlyTotals(), _CHANGES, "Append", "EventTime")
    return out.select(
        F.when(F.col("account") != "n", F.substring("account", 2, 1 << 30).cast(kind)).alias("account_id"),
        F.when(F.col("hour") != NO_HOUR, F.timestamp_seconds("hour")).alias("log_ts"), "kind", "amount")


def fold(changelog: DataFrame) -> DataFrame:
    """The report that a changelog amounts to."""
    signed = F.when(F.col("kind") == BEFORE, -F.col("amount")).otherwise(F.col("amount"))
    return changelog.groupBy("account_id", "log_ts").agg(F.sum(signed).alias("amount"))


def write_changes(spark: SparkSession, transactions: DataFrame, path: str,
                  checkpoint: str, buckets: int = BUCKETS) -> DataFrame:
    """Run the stream over the data present now into an exactly-once file sink
    and return the changelog written so far."""
    found = changes(transactions, buckets)
    query = (found.writeStream.format("parquet").outputMode("append")
             .option("path", path).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(found.schema).parquet(path)
