"""Mix sources to target weights by capped water-filling.

Each source is offered a share of the total in proportion to its weight, but
never more than ``max_epochs`` times its own size; what a clamped source can't
take is shared among the others in proportion until none is above its cap.
That fixed point is a water level: order the sources by cap / weight and clamp
them one after the other; the level after clamping the first i is the rest of
the total over the rest of the weights, and its maximum over i is the answer.
So one window over the sources (one row each) replaces the iteration.

A source then gets whole repetitions of all its documents and a seeded
fractional one: the documents whose running size, in the order of a keyed
hash, ends nearest to the rest of the target. Running sizes come from totals
of hash ranges, so a source with a third of all rows is spread over 4,096
windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwright.llm.common import materialise, n_words, null_key

SEED = "mix-1"
#: The keyed hash has 60 bits; its top 12 name the hash range.
RANGE_SHIFT = 48


def keyed_hash(seed: str, key: Column) -> Column:
    """60 bits of md5(seed:key); a null key hashes as the empty string."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def water_fill(sources: DataFrame, total: Column, max_epochs: int) -> DataFrame:
    """``sources`` (source_key, weight, source_size) with ``target``.

    One row per source goes through one task, as the level needs them all.
    A source of size 0 gets target 0.
    """
    every = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("weight"), "source_key")
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    level = ((total - F.coalesce(F.sum("cap").over(ahead), F.lit(0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(ahead), F.lit(0))))
    return (sources.withColumn("cap", F.col("source_size") * max_epochs)
            .withColumn("_level", level)
            .withColumn("_level", F.max("_level").over(every))
            .withColumn("target", F.least(F.col("cap").cast("double"),
                                          F.col("weight") * F.col("_level")))
            .drop("_level", "cap"))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3,
        seed: str = SEED, keep: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, source, text_hash, size, source_size,
    target, repeats, taken, and the columns ``keep``.

    ``size`` counts words; null and empty texts have 0. Sources rank by code
    point, a null source last as a source of its own; weights repeat over the
    ranks. ``taken`` = size * repeats. Repeated rows are separate documents;
    equal doc_ids in one source follow each other by size and text hash, so
    reruns agree. A source without words has target 0; its documents cost no
    words and appear once. Very long texts are counted whole; an empty table gives no rows.
    The input's other columns are not read.
    """
    rows = materialise(docs.select(
        "doc_id", "source", null_key("source").alias("source_key"), n_words(F.col("text")).alias("size"),
        F.xxhash64("text").alias("text_hash"),
        keyed_hash(seed, F.col("doc_id")).alias("_h"), *keep), "mix-sizes")
    ranges = rows.groupBy("source_key", F.shiftright("_h", RANGE_SHIFT).alias("_range")).agg(
        F.min("source").alias("source"), F.sum("size").alias("_range_size"))
    ranges = materialise(ranges, "mix-ranges")
    sources = ranges.groupBy("source_key").agg(F.min("source").alias("source"),
                                               F.sum("_range_size").alias("source_size"))
    by_rank = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    sources = sources.withColumn("weight", F.get(
        cycle, (F.row_number().over(by_rank) - 1) % len(weights)))
    filled = water_fill(sources, F.sum("source_size").over(Window.partitionBy()), max_epochs)
    filled = filled.select(
        "source_key", "source_size", "target",
        F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).alias("whole"))
    ahead = Window.partitionBy("source_key").orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = (ranges.select("source_key", "_range", F.coalesce(
                  F.sum("_range_size").over(ahead), F.lit(0)).alias("_start"))
              .join(filled, "source_key"))
    within = (Window.partitionBy("source_key", "_range")
              .orderBy("_h", F.col("doc_id").asc_nulls_last(), "size", "text_hash")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    return (rows.withColumn("_range", F.shiftright("_h", RANGE_SHIFT))
            .withColumn("_upto", F.sum("size").over(within))
            .join(starts, ["source_key", "_range"])
            .withColumn("repeats", F.least(F.lit(max_epochs), F.col("whole") + F.when(
                2 * (F.col("_start") + F.col("_upto")) - F.col("size") <= 2 * rest, 1)
                .otherwise(0)).cast("long"))
            .withColumn("taken", F.col("size") * F.col("repeats"))
            .select("doc_id", "source", "text_hash", "size", "source_size", "target", "repeats",
                    "taken", *keep))


def mixed_documents(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3,
                    seed: str = SEED) -> DataFrame:
    """``docs`` with each document as often as ``mix`` repeats it (not at all
    for 0), a document's copies next to each other. All columns are kept. Repeated
    rows are documents of their own: rows get numbers, by which they meet their
    repeats, so no group of equal rows meets in a task.
    """
    names = docs.columns
    keyed = materialise(docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)],
                                    F.monotonically_increasing_id().alias("_row")), "mix-rows")
    numbered = keyed.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)
                              if c in ("doc_id", "source", "text")], "_row")
    plan = materialise(
        mix(numbered, weights, max_epochs, seed, keep=["_row"])
        .filter("repeats > 0").select("_row", F.col("repeats").cast("int").alias("_repeats")),
        "mix-plan")
    # The narrow side is hashed, so texts aren't sorted for the join.
    taken = keyed.join(plan.hint("shuffle_hash"), "_row")
    return (taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_repeats"))))
            .select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)]))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source),
lv AS (
  SELECT *, ((SELECT sum(source_size) FROM s)::DOUBLE
             - coalesce(sum(3 * source_size) OVER a, 0)::DOUBLE)
            / ((SELECT sum(w) FROM s)::DOUBLE - coalesce(sum(w) OVER a, 0)::DOUBLE) AS lev
  FROM s WINDOW a AS (ORDER BY 3 * source_size / w, source NULLS FIRST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, w * (SELECT max(lev) FROM lv)) AS target
  FROM lv),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         coalesce(floor(t.target / nullif(t.source_size, 0)), 0)::BIGINT AS whole,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       size * (whole + CASE WHEN 2 * upto - size <= 2 * (target - whole * source_size)
                            THEN 1 ELSE 0 END)::BIGINT AS taken
FROM r
"""
