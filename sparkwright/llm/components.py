"""Connected components by alternating stars.

Each round links every node's larger neighbours, then its smaller ones, to the
smallest neighbour. Edges never grow in number, and the rounds needed grow with
the logarithm of the node count. A hub holds many edges: the minima are partial
aggregates, and they are written before they are joined back, so both join
sides are plain exchanges whose skewed partitions Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.llm.common import drop_scratch, materialise, scratch_mark, scratch_since


def _signature(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) but the roots.

    ``root`` is the smallest node of the component. Loops, repeated edges and
    either direction are allowed; edges with a null end are ignored; no edges
    give no rows. Raises if ``max_rounds`` don't suffice.
    """
    spark = edges.sparkSession
    start = (edges.filter("a != b")
             .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = scratch_mark()
    now = materialise(start, "edges")
    before = _signature(now)
    for _ in range(max_rounds):
        if before[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")),
                            "least")
        large = materialise(both.filter("v > u").join(least, "u")
                            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
                            "large-star")
        least = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        pairs = large.join(least, "u")
        now = materialise(
            pairs.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        made = scratch_since(mark)
        drop_scratch(spark, [p for p in made[:-1] if p])
        after = _signature(now)
        if after == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
