"""Keyed-pair operators: join (J1, J6) and cogroup.

In a cogroup the inputs are tagged, unioned and counted once by (key, side,
value), and each key's values of a side are cut into pages. Row p of a key holds
page p of every side. Null values and null keys are kept, an absent side gives
an empty list, lists are sorted. ``collect.py`` says how pages are made without
gathering a key; the long form ``cogroup_counts`` has no lists at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.operators.collect import PAGE, collect_counts, list_of, paged_counts


def pair_join(left: DataFrame, right: DataFrame, key: str = "k") -> DataFrame:
    """``rdd1.join(rdd2)`` on DataFrames ``(k, v)`` and ``(k, w)``.

    Also J6: flattening a cogroup into the pairs of its two lists is by
    definition this inner join, which builds no lists.
    """
    return left.join(right, key, "inner")


def _names(inputs: Sequence[DataFrame], names: Sequence[str] | None) -> list[str]:
    names = list(names or [f"l{i}" for i in range(len(inputs))])
    if len(names) != len(inputs):
        raise ValueError("one name per input")
    return names


def cogroup(inputs: Sequence[DataFrame], key: str = "k", value: str = "v",
            names: Sequence[str] | None = None, page: int = PAGE) -> DataFrame:
    """N-way cogroup of ``(key, value)`` inputs.

    Output ``(key, page, <name_1>, ..., <name_n>)``, one sorted list of at most
    ``page`` values per input; with lists below that, one row per key.
    """
    names = _names(inputs, names)
    values = [f"_v{j}" for j in range(len(names))]
    tagged = None
    for i, df in enumerate(inputs):
        part = df.select(
            F.col(key).alias("_k"), F.lit(i).alias("_side"), F.col(value).cast("string").alias("_t"),
            *[(F.col(value) if i == j else F.lit(None)).alias(v) for j, v in enumerate(values)])
        tagged = part if tagged is None else tagged.unionByName(part)
    counts = tagged.groupBy("_k", "_side", "_t", *values).agg(F.count(F.lit(1)).alias("n"))
    dealt = paged_counts(counts, ["_k", "_side"], ["_t", *values], page, F.col("_t"))
    lists = [list_of(F.col(v), F.col("n"), F.col("_side") == j).alias(name)
             for j, (v, name) in enumerate(zip(values, names))]
    return (dealt.groupBy("_k", "page").agg(*lists)
            .select(F.col("_k").alias(key), "page", *names))


def cogroup_counts(inputs: Sequence[DataFrame], key: str = "k", value: str = "v",
                   names: Sequence[str] | None = None) -> DataFrame:
    """The scalable cogroup: ``(key, side, value, n)``, values as text, one row
    per distinct value of a key on a side. ``side`` is the input's name."""
    names = _names(inputs, names)
    tagged = None
    for name, df in zip(names, inputs):
        part = df.select(F.col(key), F.lit(name).alias("side"), F.col(value).cast("string"))
        tagged = part if tagged is None else tagged.unionByName(part)
    return collect_counts(tagged, [key, "side"], F.col(value), value)


def nested_ranges(df: DataFrame, n: int, m: int, i_name: str = "i",
                  j_name: str = "j") -> DataFrame:
    """J8 (re-aimed): ``for (i <- 1 to n; j <- 1 to m)`` for every input row.

    Expressed with array functions on each row - a fixed n*m fan-out - so no
    cross join of DataFrames is planned.
    """
    grid = F.flatten(F.transform(
        F.sequence(F.lit(1), F.lit(n)),
        lambda i: F.transform(F.sequence(F.lit(1), F.lit(m)),
                              lambda j: F.struct(i.alias(i_name), j.alias(j_name)))))
    return df.select("*", F.inline(grid))
