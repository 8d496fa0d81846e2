"""Join helper (J7): broadcast only behind a checked size bound.

The plan's own size estimate comes first, as it costs no job. A side that Spark
would broadcast by its threshold anyway is left to Spark, and one estimated above
the bound is never read before the join. Only between the two does ``fits``
measure the side with one distributed aggregate: a row count and the rows' JSON
bytes (which overstate the in-memory size because they repeat the field names),
one partial row per task. When both are within their bounds the side is
broadcast. Otherwise Spark chooses a shuffle join (AQE may still convert it at
run time from the measured size).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default bounds for a broadcast side: 2 M rows and 200 MB (the largest
# broadcast threshold the reference sets).
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 200 << 20


def plan_bytes(df: DataFrame) -> int:
    """Bytes of ``df`` as the optimizer estimates them, without a job: file sizes
    scaled to the columns read, of a filter all its input, of a join the product."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def fits(df: DataFrame, max_rows: int,
         max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes."""
    row_bytes = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                       max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``F.broadcast(df)`` when its rows and bytes are proven within the bounds.
    A plan estimated above ``max_bytes`` isn't measured."""
    small = plan_bytes(df) <= max_bytes and fits(df, max_rows, max_bytes)
    return F.broadcast(df) if small else df


def sized_join(big: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "inner",
               max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
               max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Join with the small side broadcast only if its size check passes. No job
    runs first where Spark's own threshold decides or the side is too large."""
    threshold = small.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if plan_bytes(small) <= min(threshold, max_bytes):
        return big.join(small, on, how)
    return big.join(broadcast_if_small(small, max_rows, max_bytes), on, how)
