"""Distinct counting with mergeable HLL sketches.

Sketches are Spark's built-in DataSketches HLL (``hll_sketch_agg``,
``hll_union_agg``, ``hll_sketch_estimate``): they aggregate partially on the
map side and merge in the shuffle, so a day's users never meet in one task.
Sketch bytes are Spark's own; they are not read from other libraries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.sinks.upsert import KeyedUpsertSink

LG_K = 13  # 2^13 registers (about 1% standard error), as in the reference


def sketch_by(df: DataFrame, key: Column, key_name: str, value: str, lg_k: int = LG_K,
              sketch_name: str = "hll") -> DataFrame:
    """One sketch per key."""
    return df.groupBy(key.alias(key_name)).agg(
        F.hll_sketch_agg(F.col(value), lg_k).alias(sketch_name))


def daily_sketches(events: DataFrame, ts_col: str, user_col: str, lg_k: int = LG_K) -> DataFrame:
    """visit_summaries(visit_date DATE, hll BINARY): one sketch per day."""
    return sketch_by(events, F.to_date(ts_col), "visit_date", user_col, lg_k)


class SketchTable:
    """A stored ``visit_summaries`` table: one sketch per day, a folder per day.

    ``load`` adds new events: their days' sketches are merged with the stored
    ones and only those days are rewritten, so a load costs its own rows and
    days however long the history is. Loads are numbered from 0 and committed
    one by one; a load that is repeated after a crash is whole or not there, and
    one that is already committed is skipped. Questions read sketches only. A
    null time has no day and is left out; null users aren't counted.
    """

    def __init__(self, path: str, lg_k: int = LG_K):
        self.lg_k = lg_k
        self._sink = KeyedUpsertSink(path, ["visit_date"], F.unix_date("visit_date"))

    def load(self, events: DataFrame, ts_col: str, user_col: str, number: int) -> None:
        new = daily_sketches(events, ts_col, user_col, self.lg_k).filter("visit_date IS NOT NULL")
        stored = self.read(events.sparkSession)
        # New days only: the others' folders stay as they are.
        before = stored.join(new.select("visit_date"), "visit_date", "left_semi")
        merged = new.unionByName(before).groupBy("visit_date").agg(F.hll_union_agg("hll").alias("hll"))
        self._sink(merged, number)

    def read(self, spark: SparkSession) -> DataFrame:
        """(visit_date, hll)."""
        return self._sink.resolve(spark, "visit_date DATE, hll BINARY")


def estimate(df: DataFrame, value: str, lg_k: int = LG_K) -> DataFrame:
    """Build a sketch over all rows and read its cardinality."""
    return df.agg(F.hll_sketch_estimate(F.hll_sketch_agg(F.col(value), lg_k)).alias("estimate"))


def uniques_since(summaries: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """``cardinality(merge(hll))`` over visit_date >= as_of - days.

    ``as_of`` replaces ``current_date`` so results are reproducible.
    """
    start = F.date_sub(F.to_date(F.lit(as_of)), days)
    return (summaries.filter(F.col("visit_date") >= start)
            .agg(F.hll_sketch_estimate(F.hll_union_agg("hll")).alias("uniques"))
            .select(F.to_date(F.lit(as_of)).alias("as_of"), "uniques"))


def rolling_uniques(summaries: DataFrame, days: int = 7) -> DataFrame:
    """Q13 for every day: uniques over the ``days`` days ending on it.

    Each daily sketch is copied to the (at most ``days``) windows it belongs
    to - a fixed fan-out of a table with one row per day - then the copies
    are merged per window end. Only windows ending on a day present in the
    input are kept.
    """
    last = summaries.select(F.max("visit_date")).scalar()
    ends = summaries.select(
        F.explode(F.sequence(F.col("visit_date"), F.date_add("visit_date", days - 1)))
        .alias("window_end"), "hll")
    return (ends.filter(F.col("window_end") <= last)
            .groupBy("window_end")
            .agg(F.hll_sketch_estimate(F.hll_union_agg("hll")).alias("uniques")))


def rolling_exact(events: DataFrame, ts_col: str, user_col: str, days: int = 7) -> DataFrame:
    """Exact counterpart of ``rolling_uniques`` (for checking the error)."""
    pairs = events.select(F.to_date(ts_col).alias("d"), F.col(user_col).alias("u")).distinct()
    last = pairs.select(F.max("d")).scalar()
    return (pairs.select(F.explode(F.sequence("d", F.date_add("d", days - 1))).alias("window_end"),
                         "u")
            .filter(F.col("window_end") <= last)
            .groupBy("window_end").agg(F.countDistinct("u").alias("exact")))
