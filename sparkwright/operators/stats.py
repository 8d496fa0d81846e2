"""Descriptive statistics and contingency tables.

All statistics are single-pass declarative aggregates (partial + final), so
their cost is one scan and a shuffle of one partial row per task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.session import scratch_path


def describe_typed(df: DataFrame, cols: Sequence[str], digits: int | None = None) -> DataFrame:
    """A13, typed: one row per column: (column, count, mean, stddev, min, max).

    Same statistics as ``df.describe()`` (sample stddev), as doubles instead
    of strings. One aggregate computes every column; a ``stack`` turns the
    single result row into one row per column.
    """
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    stack_args = ", ".join(
        f"'{c}', `{c}__count`, `{c}__mean`, `{c}__stddev`, `{c}__min`, `{c}__max`" for c in cols)
    long = wide.selectExpr(
        f"stack({len(cols)}, {stack_args}) AS (column, count, mean, stddev, min, max)")
    if digits is not None:
        for c in ("mean", "stddev", "min", "max"):
            long = long.withColumn(c, F.round(c, digits))
    return long


def describe(df: DataFrame, *cols: str) -> DataFrame:
    """A13 as in the reference: Spark's ``describe`` (string-valued summary)."""
    return df.describe(*cols)


def cov_corr(df: DataFrame, a: str, b: str, digits: int | None = None) -> DataFrame:
    """Sample covariance and Pearson correlation in one pass."""
    cov = F.covar_samp(F.col(a).cast("double"), F.col(b).cast("double"))
    corr = F.corr(F.col(a).cast("double"), F.col(b).cast("double"))
    if digits is not None:
        cov, corr = F.round(cov, digits), F.round(corr, digits)
    return df.agg(cov.alias("cov"), corr.alias("corr"))


def crosstab(df: DataFrame, a: str, b: str, values: Sequence | None = None) -> DataFrame:
    """Contingency table; first column ``<a>_<b>`` (as string), one
    column per value of ``b``, zero for absent cells. Nulls count under ``null``.

    Without ``values`` Spark's ``pivot`` finds the values of ``b`` first (a pass
    over that column, bounded by ``spark.sql.pivotMaxValues``). ``values`` fixes
    the columns and saves that pass; a row with another value, null included
    unless ``None`` or ``"null"`` is listed, fails the job. The counting is a
    partial-aggregated group-by on (a, b).
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    head, column = f"{a}_{b}", text(b)
    if values is not None:
        values = ["null" if v is None else str(v) for v in values]
        column = F.when(column.isin(values), column).otherwise(F.raise_error(
            F.concat(F.lit(f"crosstab: a value of {b} is not listed: "), column)))
    rows = df.select(text(a).alias(head), column.alias("_column"))
    out = rows.groupBy(head).pivot("_column", values).agg(F.count(F.lit(1)))
    return out.na.fill(0, subset=out.columns[1:])


def frequent_items(df: DataFrame, col: str, support: float) -> DataFrame:
    """A17, exact: values whose frequency is at least ``support`` of all rows.

    The total is a scalar subquery, so no cross join and no driver round
    trip; the value counts are a partial-aggregated group-by.
    """
    total = df.select(F.count(F.lit(1))).scalar()
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))
            .filter(F.col("cnt") >= total * F.lit(support)))


def _counters(k: int):
    """Misra-Gries over a task's rows: at most ``k`` counters between batches.
    When there are more, all lose the size of the (k+1)-th largest."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, lost, rows, kind = {}, 0, 0, None
        for batch in batches:
            kind, rows = batch.schema.field(0).type, rows + len(batch)
            for pair in pc.value_counts(batch.column(0)).to_pylist():
                held[pair["values"]] = held.get(pair["values"], 0) + pair["counts"]
            if len(held) > k:
                cut = sorted(held.values(), reverse=True)[k]
                held = {v: n - cut for v, n in held.items() if n > cut}
                lost += cut
        if kind is not None:
            values = [None, *held]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind), pa.array([True] + [False] * len(held)),
                 pa.array([rows, *held.values()], pa.int64()),
                 pa.array([lost] + [0] * len(held), pa.int64())],
                ["value", "is_total", "n", "lost"])
    return run


def heavy_hitters(df: DataFrame, col: str, support: float, slack: int = 4) -> DataFrame:
    """A17 in one pass with bounds: (col, lower, upper) of every value that may
    have at least ``support`` of all rows.

    Each task summarises its rows in ``slack / support`` counters; the tasks'
    summaries (bounded, written to the scratch folder) are added up. ``lower`` is
    what was counted, ``upper`` adds what the tasks may have lost, at most
    ``support / slack`` of all rows. So no frequent value is missing, and none
    below ``support * (1 - 1 / slack)`` is returned. Null is a value. Floats that
    compare equal must be identical. An empty input gives no rows.
    """
    if not 0 < support <= 1 or slack < 2:
        raise ValueError("support must be above 0 and at most 1, slack at least 2")
    kind = df.select(col).schema[0].dataType.simpleString()
    path = scratch_path(df.sparkSession, "counters")
    schema = f"value {kind}, is_total BOOLEAN, n BIGINT, lost BIGINT"
    (df.select(F.col(col).alias("value")).mapInArrow(_counters(int(-(-slack // support))), schema)
     .write.parquet(path))
    parts = df.sparkSession.read.schema(schema).parquet(path)
    totals = parts.filter("is_total").agg(F.sum("n").alias("rows"), F.sum("lost").alias("lost"))
    found = parts.filter("not is_total").groupBy("value").agg(F.sum("n").alias("lower"))
    upper = F.col("lower") + totals.select("lost").scalar()
    return (found.select(F.col("value").alias(col), "lower", upper.alias("upper"))
            .filter(F.col("upper") >= totals.select("rows").scalar() * F.lit(support)))


def frequent_items_approx(df: DataFrame, cols: Sequence[str], support: float) -> DataFrame:
    """A17 as in the reference: Spark's one-pass ``freqItems`` (may include
    false positives, never misses a frequent item)."""
    return df.stat.freqItems(list(cols), support)
