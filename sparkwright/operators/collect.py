"""Collect values per key into lists, with a hot key spread over pages.

``collect_counts`` is the scalable form: one row per distinct (key, value) with
its count. It is exact at any size and no key is ever gathered in one place.

``collect_lists`` is the list form: a key's values, in the order of their hash,
are cut into pages of at most ``page`` values, and each page is one row with a
sorted list. The places come from counts: each distinct value of a key is
counted before the shuffle, counts are summed per key and range of hashes, the
ranges' running sums (at most ``RANGES`` per key) give every range its first
place, and a window inside a range gives every value its own. So a key with a
third of all rows is spread over ranges and then over pages, and a value with a
third of all rows is one counted row until it is dealt out to its pages. Nulls
are values like any other, and a null key is a key like any other. The union of
a key's pages is exactly its values, repeats included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values of a page; hash ranges per key (the top bits of a 32-bit hash).
PAGE = 10_000
RANGES, _HASH_BITS = 4096, 32


def _cols(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def value_hash(value: Column) -> Column:
    """The first 32 bits of the md5 of the value as text (null as the empty text)."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, _HASH_BITS // 4), 16, 10).cast("long")


def collect_counts(df: DataFrame, keys: str | Sequence[str], value: Column,
                   alias: str) -> DataFrame:
    """Rows ``(keys..., alias, n)``: how often each key has each value."""
    ks = _cols(keys)
    return (df.select(*ks, value.alias(alias)).groupBy(*ks, alias)
            .agg(F.count(F.lit(1)).alias("n")))


def paged_counts(counts: DataFrame, keys: str | Sequence[str], values: str | Sequence[str],
                 page: int, hash_by: Column) -> DataFrame:
    """``counts`` (keys, values, n), one row per distinct (keys, values), dealt
    out to pages: with ``page`` and ``n`` = how often the value is in that page.

    The order is by ``hash_by`` as text, ties by the values. Column names
    starting with ``_p_`` are taken.
    """
    if page < 1:
        raise ValueError("page must be at least 1")
    ks, vs = _cols(keys), _cols(values)
    rows = counts.withColumn("_p_hash", value_hash(hash_by)).withColumn(
        "_p_range", F.shiftright("_p_hash", _HASH_BITS - RANGES.bit_length() + 1))
    # At most RANGES rows of a key meet in this window.
    ahead = Window.partitionBy(*ks).orderBy("_p_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy(*ks, "_p_range").agg(F.sum("n").alias("_p_n"))
              .select(*[F.col(k).alias(f"_p_k{i}") for i, k in enumerate(ks)],
                      F.col("_p_range").alias("_p_r"),
                      F.coalesce(F.sum("_p_n").over(ahead), F.lit(0)).alias("_p_start")))
    same = F.col("_p_range") == F.col("_p_r")
    for i, k in enumerate(ks):
        same &= F.col(k).eqNullSafe(F.col(f"_p_k{i}"))
    here = Window.partitionBy(*ks, "_p_range").orderBy("_p_hash", *vs).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = (rows.withColumn("_p_upto", F.sum("n").over(here)).join(starts, same)
              .withColumn("_p_upto", F.col("_p_upto") + F.col("_p_start"))
              .withColumn("_p_from", F.col("_p_upto") - F.col("n")))
    first = F.floor(F.col("_p_from") / page)
    last = F.floor((F.col("_p_upto") - 1) / page)
    out = placed.withColumn("page", F.explode(F.sequence(first, last)))
    held = (F.least("_p_upto", (F.col("page") + 1) * page)
            - F.greatest("_p_from", F.col("page") * page))
    return out.select(*ks, "page", *vs, held.alias("n"))


def list_of(value: Column, n: Column, when: Column | None = None) -> Column:
    """Sorted list of ``value``, each ``n`` times, nulls first and kept, of the
    rows where ``when`` holds."""
    held = F.struct(value.alias("v"), n.cast("int").alias("n"))
    held = F.sort_array(F.collect_list(held if when is None else F.when(when, held)))
    return F.flatten(F.transform(held, lambda x: F.array_repeat(x["v"], x["n"])))


def collect_lists(df: DataFrame, keys: str | Sequence[str], value: Column, alias: str,
                  page: int = PAGE, hash_by: Column | None = None) -> DataFrame:
    """Rows ``(keys..., page, alias)`` with ``alias`` = sorted list of at most
    ``page`` values; pages of a key count from 0 and all but the last are full.

    ``hash_by``, over the column ``alias``, names what is hashed where ``value``
    has no text form. Values must be comparable.
    """
    ks = _cols(keys)
    counts = collect_counts(df, ks, value, alias)
    dealt = paged_counts(counts, ks, alias, page, F.col(alias) if hash_by is None else hash_by)
    return dealt.groupBy(*ks, "page").agg(list_of(F.col(alias), F.col("n")).alias(alias))
