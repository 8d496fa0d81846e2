"""Registered functions (U1-U3): SQL-callable, with native fast paths.

* U1 ``one_arg_filter(x) = x > 5``: registered for SQL as an Arrow-batched
  pandas UDF; ``gt_five`` is the native expression for the DataFrame API.
* U2 ``explode_json_array(s)``: JSON array string -> rows ``items``; native
  ``explode(from_json)``, plus a Python UDTF for the ``LATERAL`` SQL form.
* U3 ``union_id_guard(s)``: null or empty returned as is, anything else null.

``register_sql`` registers all three as SQL-language functions: Catalyst puts
their bodies into the plan, so a call by name costs no Python worker.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from sparkwright.functions.columns import json_string_array, null_or_empty


def gt_five(c: str | Column) -> Column:
    """U1 native form."""
    return (F.col(c) if isinstance(c, str) else c) > 5


# A DataType, not a DDL string: workers import this module to load the UDTF
# class below, and parsing a DDL string there would need a session.
@pandas_udf(T.BooleanType())
def one_arg_filter(x: pd.Series) -> pd.Series:
    """U1 for SQL: Arrow batches, not rows. A null argument gives null (the
    Java UDF would throw on unboxing; SQL ``WHERE`` drops null either way)."""
    return (x > 5).astype("boolean")


def explode_json_array(c: str | Column, name: str = "items", lenient: bool = False) -> Column:
    """U2 native form: one row per element, as strings. Null or malformed input
    fails the job, or gives no rows if ``lenient``."""
    return F.explode(json_string_array(c, lenient)).alias(name)


def union_id_guard(c: str | Column) -> Column:
    """The observable behaviour of the reference UDF."""
    x = F.col(c) if isinstance(c, str) else c
    return F.when(null_or_empty(x), x).otherwise(F.lit(None).cast("string"))


class ExplodeJsonArray:
    """U2 SQL table function: ``SELECT ... FROM t, LATERAL explode_json_array(s)``.

    Exactly one string argument; a null argument is an error, as in the
    reference. Used only when SQL text needs the table-function form.
    """

    def eval(self, s: str):
        if s is None:
            raise ValueError("explode_json_array: argument is null")
        for item in json.loads(s):
            yield (item if isinstance(item, str) or item is None else json.dumps(item),)


def register_all(spark: SparkSession) -> None:
    """Register U1 and U2 under SQL names."""
    spark.udf.register("one_arg_filter", one_arg_filter)
    from pyspark.sql.functions import udtf
    spark.udtf.register("explode_json_array", udtf(
        ExplodeJsonArray, returnType="items string", useArrow=True))


# Name, parameters and result, body. A malformed or null array fails the job.
_SQL_FUNCTIONS = (
    ("gt_five", "(x DOUBLE) RETURNS BOOLEAN", "x > 5"),
    ("json_array_rows", "(s STRING) RETURNS TABLE(items STRING)",
     "SELECT explode(coalesce(from_json(s, 'array<string>'), "
     "raise_error(concat('not a JSON array: ', coalesce(s, 'null')))))"),
    ("null_or_empty_guard", "(s STRING) RETURNS STRING",
     "CASE WHEN s IS NULL OR length(s) = 0 THEN s END"),
)


def register_sql(spark: SparkSession) -> None:
    """Register U1, U2 and U3 as temporary SQL functions: ``gt_five(x)``, the table
    function ``json_array_rows(s)`` and ``null_or_empty_guard(s)``."""
    for name, signature, body in _SQL_FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{signature} RETURN {body}")


def json_items(df: DataFrame, col: str, keep: list[str] | None = None,
               lenient: bool = False) -> DataFrame:
    """U2 on a DataFrame: the ``keep`` columns plus ``items``."""
    return df.select(*(keep or []), explode_json_array(col, lenient=lenient))
