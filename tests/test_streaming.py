"""Streaming spend report: stream equals batch with out-of-order files (T2);
the windowed form (T3) drops rows behind the watermark."""

import datetime as dt
import os
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkwright.session import scratch_path
from sparkwright.streaming.spend import report, run_to_completion

SCHEMA = "account_id BIGINT, amount BIGINT, transaction_time TIMESTAMP"


def _drop(spark, root, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{root}/{name}")
    time.sleep(0.05)  # distinct modification times keep the file order


def _batches():
    t = dt.datetime(2024, 1, 1, 10, 0, 0)
    early = [(1, 100, t), (2, 50, t + dt.timedelta(minutes=5))]
    later = [(1, 10, t + dt.timedelta(hours=3)), (2, 5, t + dt.timedelta(hours=3, minutes=1))]
    late = [(1, 7, t + dt.timedelta(minutes=30))]  # 2.5 h behind the watermark
    return early, later, late


def _stream(spark, root, windowed):
    src = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/*")
    tx = src.withWatermark("transaction_time", "5 seconds")
    return run_to_completion(spark, tx, scratch_path(spark, "t-sink"),
                             scratch_path(spark, "t-ckpt"), windowed=windowed)


def test_stream_equals_batch_with_late_rows(spark):
    root = scratch_path(spark, "t-src")
    early, later, late = _batches()
    _drop(spark, root, "f1", early)
    _drop(spark, root, "f2", later)
    _drop(spark, root, "f3", late)
    got = {(r.account_id, r.log_ts, r.amount) for r in _stream(spark, root, False).collect()}
    batch = report(spark.createDataFrame(early + later + late, SCHEMA)).withColumn(
        "log_ts", F.col("log_ts").cast("timestamp_ntz"))
    assert got == {tuple(r) for r in batch.collect()}
    assert (1, dt.datetime(2024, 1, 1, 10, 0), 107) in got


def test_windowed_form_drops_late_rows(spark):
    """Spark drops a row when it is behind the watermark of the previous
    micro-batch; the 10:40 row arrives after the 13:01 row's batch has moved
    the watermark past its window, so T3 drops it while T2 keeps it."""
    root = scratch_path(spark, "t-src")
    early, later, late = _batches()
    _drop(spark, root, "f1", early)
    _drop(spark, root, "f2", later)
    _drop(spark, root, "f3", late)
    _drop(spark, root, "f4", [(1, 3, dt.datetime(2024, 1, 1, 10, 40))])
    _drop(spark, root, "f5", [(3, 1, dt.datetime(2024, 1, 1, 20, 0))])
    windowed = {(r.account_id, r.log_ts, r.amount) for r in _stream(spark, root, True).collect()}
    assert (1, dt.datetime(2024, 1, 1, 10, 0), 107) in windowed
    kept = {(r.account_id, r.log_ts, r.amount) for r in _stream(spark, root, False).collect()}
    assert (1, dt.datetime(2024, 1, 1, 10, 0), 110) in kept


def test_replayed_batch_is_idempotent(spark):
    from sparkwright.sinks.upsert import KeyedUpsertSink
    path = scratch_path(spark, "t-upsert")
    sink = KeyedUpsertSink(path, ["k"])
    b0 = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "k long, v long")
    b1 = spark.createDataFrame([(1, 11)], "k long, v long")
    assert sink.resolve(spark, "k long, v long").count() == 0
    sink(b0, 0)
    sink(b1, 1)
    sink(b1, 1)  # replay after a failure
    rows = lambda: sorted(map(str, map(tuple, sink.resolve(spark).collect())))
    assert rows() == ["(1, 11)", "(2, 20)", "(None, 30)"]
    sink(spark.createDataFrame([(1, 12)], "k long, v long"), 2)  # writes go on after a read
    sink(b0.limit(0), 3)
    assert rows() == ["(1, 12)", "(2, 20)", "(None, 30)"]
    with pytest.raises(ValueError, match="bucket"):
        sink(b0.withColumn("Bucket", F.lit(1)), 4)


def _files(path):
    return sorted(os.path.join(d, f) for d, _, files in os.walk(path) for f in files
                  if f.endswith(".parquet"))


def test_a_batch_that_died_between_buckets_is_replaced(spark, monkeypatch):
    """Some buckets of the batch are written, then the driver dies: readers see
    the batch before, and the replay gives the whole batch."""
    import shutil

    from sparkwright.sinks import upsert
    path = scratch_path(spark, "t-upsert")
    sink = upsert.KeyedUpsertSink(path, ["k"], buckets=8)
    sink(spark.range(100).select(F.col("id").alias("k"), F.lit(0).alias("v")), 0)
    batch = spark.range(50, 150).select(F.col("id").alias("k"), F.lit(1).alias("v"))

    def dies(self, *a):
        raise RuntimeError("killed")
    with monkeypatch.context() as m:
        m.setattr(upsert.KeyedUpsertSink, "_clean", dies)
        with pytest.raises(RuntimeError):
            sink(batch, 1)
    # The whole batch lies there; take back its marker and half of its buckets.
    shutil.rmtree(f"{path}/committed/batch=1")
    for b in range(4):
        shutil.rmtree(f"{path}/data/batch=1/bucket={b}")
    assert {r.k: r.v for r in sink.resolve(spark).collect()} == dict.fromkeys(range(100), 0)
    sink(batch, 1)
    want = dict.fromkeys(range(50), 0) | dict.fromkeys(range(50, 150), 1)
    assert {r.k: r.v for r in sink.resolve(spark).collect()} == want
    # Died after the commit, before the cleaning: nothing is read twice, the next batch cleans.
    with monkeypatch.context() as m:
        m.setattr(upsert.KeyedUpsertSink, "_clean", dies)
        with pytest.raises(RuntimeError):
            sink(batch.withColumn("v", F.lit(2)), 2)
    want |= dict.fromkeys(range(50, 150), 2)
    assert {r.k: r.v for r in sink.resolve(spark).collect()} == want
    sink(batch.filter("k = 60").withColumn("v", F.lit(3)), 3)
    assert {r.k: r.v for r in sink.resolve(spark).collect()} == want | {60: 3}
    assert len(_files(path)) <= 8 and sink.resolve(spark).count() == 150


def test_a_hundred_batches_take_the_space_of_one(spark):
    from sparkwright.sinks.upsert import KeyedUpsertSink
    many, one = (scratch_path(spark, "t-upsert") for _ in range(2))
    sink = KeyedUpsertSink(many, ["k"], buckets=4)
    for n in range(100):
        sink(spark.range(n % 7, n % 7 + 5).select(F.col("id").alias("k"), F.lit(n).alias("v")), n)
    whole = sink.resolve(spark)
    assert {r.k: r.v for r in whole.collect()} == {
        k: max(n for n in range(100) if n % 7 <= k < n % 7 + 5) for k in range(11)}
    KeyedUpsertSink(one, ["k"], buckets=4)(whole, 0)
    sizes = [sum(map(os.path.getsize, _files(p))) for p in (many, one)]
    assert len(_files(many)) == len(_files(one)) and sizes[0] <= 1.1 * sizes[1]
    assert len(os.listdir(f"{many}/committed")) <= 5


def test_changelog_folds_to_the_report_and_its_state_expires(spark):
    from sparkwright.streaming.changelog import AFTER, BEFORE, INSERT, changes, fold, write_changes
    root = scratch_path(spark, "t-src")
    t = dt.datetime(2024, 1, 1, 10)
    steps = [[(1, 100, t), (2, 50, t), (1, 1, t + dt.timedelta(minutes=9)), (None, 4, t)],
             [(1, 7, t + dt.timedelta(minutes=20)), (3, None, t)],
             [(1, 5, t + dt.timedelta(hours=5))],        # the watermark passes the first hour
             [(1, 9, t + dt.timedelta(hours=5, minutes=1))],
             [(1, 1000, t + dt.timedelta(minutes=30))]]  # behind it: dropped, no second insert
    for i, rows in enumerate(steps):
        _drop(spark, root, f"f{i}", rows)
    src = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/*")
    ckpt = scratch_path(spark, "t-ckpt")
    log = write_changes(spark, src.withWatermark("transaction_time", "1 hour"),
                        scratch_path(spark, "t-log"), ckpt)
    h0, h5 = t, t + dt.timedelta(hours=5)
    got = Counter((r.account_id, r.log_ts, r.kind, r.amount) for r in log.collect())
    assert got == Counter([
        (1, h0, INSERT, 101), (2, h0, INSERT, 50), (None, h0, INSERT, 4), (1, h0, BEFORE, 101),
        (1, h0, AFTER, 108), (3, h0, INSERT, 0), (1, h5, INSERT, 5), (1, h5, BEFORE, 5),
        (1, h5, AFTER, 14)])
    folded = {(r.account_id, r.log_ts): r.amount for r in fold(log).collect()}
    in_time = report(spark.createDataFrame(sum(steps[:-1], []), SCHEMA))
    assert folded == {(r.account_id, r.log_ts): r.amount or 0 for r in in_time.collect()}
    # The first hour's four keys are gone from the state.
    held = spark.read.format("statestore").option("path", ckpt).option(
        "stateVarName", "total").load()
    assert held.count() == 1
    assert changes(src.withWatermark("transaction_time", "1 hour")).isStreaming


def test_changelog_touches_the_state_once_for_many_accounts(spark):
    """A micro-batch calls the processor once per hour and bucket, not per account:
    the state has as many keys; a second batch updates and adds accounts there."""
    from sparkwright.streaming.changelog import AFTER, BEFORE, INSERT, fold, write_changes
    root, ckpt = scratch_path(spark, "t-src"), scratch_path(spark, "t-ckpt")
    t, next_hour = dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 11)
    first = [(a, a + 1, t) for a in range(300)] + [(None, None, t), (7, None, None), (7, (1 << 53) + 1, t)]
    second = [(a, 1000, t) for a in range(200, 400)] + [(7, 2, None), (None, 3, next_hour)]
    for i, rows in enumerate((first, second)):
        _drop(spark, root, f"f{i}", rows)
    src = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/*")
    log = write_changes(spark, src.withWatermark("transaction_time", "3 hours"),
                        scratch_path(spark, "t-log"), ckpt, buckets=4)
    kinds = Counter(r.kind for r in log.collect())
    assert kinds == {INSERT: 302 + 101, BEFORE: 101, AFTER: 101}
    got = {(r.account_id, r.log_ts): r.amount for r in fold(log).collect()}
    whole = report(spark.createDataFrame(first + second, SCHEMA))
    assert got == {(r.account_id, r.log_ts): r.amount or 0 for r in whole.collect()}
    held = spark.read.format("statestore").option("path", ckpt).option("stateVarName", "total").load()
    assert held.count() == 403 and held.select("key").distinct().count() <= 4 + 1 + 1


def test_merge_sink_hands_over_one_row_per_key(spark):
    from sparkwright.sinks.upsert import MergeSink
    seen = {}

    def merge(batch, batch_id):
        seen[batch_id] = sorted(map(tuple, batch.collect()))

    sink = MergeSink(merge, ["k"], order="seq")
    sink(spark.createDataFrame([(1, 10, 1), (1, 11, 2), (2, 5, 1)], "k long, v long, seq long"), 7)
    assert seen == {7: [(1, 11, 2), (2, 5, 1)]}


def test_windowed_query_in_time_order_is_batch_minus_open_hours(spark):
    """The registered T3 query stages its input in event-time order, so no row
    is late: every emitted window equals the batch total, and only windows
    still open at the final watermark (the last hours) are missing."""
    import __spark_entry__ as ent
    sf = "/root/testdata/sf0.001"
    win = {(r.account_id, r.log_ts): r.amount
           for r in ent.queries()["spend_report_window"](spark, sf).collect()}
    batch = {(r.account_id, r.log_ts): r.amount
             for r in ent.queries()["spend_report_batch"](spark, sf).collect()}
    assert win and all(batch[k] == v for k, v in win.items())
    missing = set(batch) - set(win)
    last_hour = max(k[1] for k in batch)
    assert all(k[1] >= last_hour - dt.timedelta(hours=1) for k in missing)
