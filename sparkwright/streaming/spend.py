"""Hourly spend report (Q12; T1-T6, K7).

``report`` is a pure DataFrame -> DataFrame function used unchanged on a
batch table and on a stream, so the batch result is the oracle of the stream.

Stream form (reference semantics, T2): the group key is a plain floored
timestamp, so the watermark never closes a group; output mode ``update``
emits the new total of every key touched by a micro-batch, and the keyed
upsert sink keeps the latest total per (account_id, log_ts). State grows
with the number of (account, hour) keys, as in the reference.

Bounded form (T3): a 1-hour tumbling ``window`` lets the watermark evict
state and drop late rows; it is offered as an option and may differ from
the batch result for late data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkwright.sinks.upsert import KeyedUpsertSink

KEYS = ("account_id", "log_ts")


def transactions_from_events(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Fixture mapping: account = user, amount = integer cents, event time as
    TIMESTAMP (``withWatermark`` refuses TIMESTAMP_NTZ)."""
    return events.select(
        F.col("user_id").alias("account_id"),
        F.round(F.col("value") * 100).cast("long").alias("amount"),
        F.col("ts").cast("timestamp").alias("transaction_time"), *(keep or []))


def report(transactions: DataFrame) -> DataFrame:
    """Sum of amount per (account_id, hour of transaction_time)."""
    return (transactions
            .groupBy("account_id", F.date_trunc("hour", "transaction_time").alias("log_ts"))
            .agg(F.sum("amount").alias("amount")))


def windowed_report(transactions: DataFrame) -> DataFrame:
    """1-hour tumbling windows; state is evicted past the watermark."""
    return (transactions
            .groupBy("account_id", F.window("transaction_time", "1 hour"))
            .agg(F.sum("amount").alias("amount"))
            .select("account_id", F.col("window.start").alias("log_ts"), "amount"))


def as_ntz(df: DataFrame) -> DataFrame:
    """Output with ``log_ts`` as TIMESTAMP_NTZ (the fixture's type)."""
    return df.withColumn("log_ts", F.col("log_ts").cast("timestamp_ntz"))


def start_report_stream(transactions: DataFrame, sink: KeyedUpsertSink, checkpoint: str,
                        trigger: dict | None = None, windowed: bool = False) -> StreamingQuery:
    """Run the report into the keyed upsert sink.

    ``trigger`` defaults to ``availableNow`` (process what is there, then
    stop); pass ``{"processingTime": "5 seconds"}`` for a continuous tail.
    The checkpoint folder (T6) makes restarts exactly-once together with the
    sink's per-batch-id idempotence.
    """
    agg = windowed_report(transactions) if windowed else report(transactions)
    writer = (agg.writeStream
              .outputMode("append" if windowed else "update")
              .foreachBatch(sink)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()


def run_to_completion(spark: SparkSession, transactions: DataFrame, sink_path: str,
                      checkpoint: str, windowed: bool = False,
                      interval: str | None = None, buckets: int = 16) -> DataFrame:
    """Run the stream until the data present now is processed and return the
    resolved sink table. Default trigger ``availableNow``; with ``interval``
    a continuous ``processingTime`` tail (T5) that is drained, then stopped."""
    sink = KeyedUpsertSink(sink_path, KEYS, buckets)
    trigger = {"processingTime": interval} if interval else None
    query = start_report_stream(transactions, sink, checkpoint, trigger=trigger,
                                windowed=windowed)
    if interval:
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    else:
        query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return as_ntz(sink.resolve(spark, report(transactions).schema))
