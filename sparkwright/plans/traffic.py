"""Phone-traffic totals (Q11): tab-separated log lines -> up/down/total per key.

P13 parse: field 1 is the key, fields 8 and 9 are longs. A12: three sums per
key as BIGINT (the reference's int accumulators wrap; these do not).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.functions.columns import joined_fields


def parse_traffic(lines: DataFrame, value_col: str = "value", lenient: bool = False) -> DataFrame:
    """Rows (key, up, down, sum_flow). A missing or malformed number fails the
    job (reference behaviour), whatever the session's ANSI setting, unless
    ``lenient``, which gives null instead."""
    parts = F.split(F.col(value_col), "\t", -1)

    def num(i: int):
        parsed = F.get(parts, i).try_cast("long")
        if lenient:
            return parsed
        bad = F.raise_error(F.concat(F.lit(f"malformed traffic line (field {i + 1}): "),
                                     F.col(value_col)))
        return F.when(parsed.isNull(), bad).otherwise(parsed)

    up, down = num(8), num(9)
    return lines.select(F.get(parts, 1).alias("key"), up.alias("up"), down.alias("down"),
                        (up + down).alias("sum_flow"))


def traffic_totals(lines: DataFrame, value_col: str = "value", lenient: bool = False) -> DataFrame:
    """Q11: per key, total up, down and sum (one partial-aggregated shuffle)."""
    return (parse_traffic(lines, value_col, lenient)
            .groupBy("key")
            .agg(F.sum("up").alias("up"), F.sum("down").alias("down"),
                 F.sum("sum_flow").alias("sum_flow")))


def traffic_text_lines(totals: DataFrame) -> DataFrame:
    """K5 output line ``key<TAB>up down sum``."""
    return totals.select(F.concat(F.col("key"), F.lit("\t"),
                                  joined_fields(" ", [F.col("up"), F.col("down"), F.col("sum_flow")]))
                         .alias("value"))
