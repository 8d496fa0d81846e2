"""Shared helpers: word pattern, scratch tables and null-safe keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwright.session import scratch_path

#: A word: a maximal run of characters other than space, tab, LF, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

_CREATED: list[str] = []


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to a new table in the shared scratch folder and read it back.

    Cuts the lineage the way ``checkpoint()`` does, but in columnar form. The
    files survive the loss of any executor; ``drop_scratch`` deletes them.
    """
    path = scratch_path(df.sparkSession, f"llm-{purpose}")
    df.write.parquet(path)
    _CREATED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_scratch(spark, purpose: str) -> str:
    """A fresh scratch folder, listed for ``drop_scratch``."""
    path = scratch_path(spark, f"llm-{purpose}")
    _CREATED.append(path)
    return path


def scratch_mark() -> int:
    """A position in the list of scratch folders, for ``scratch_since``."""
    return len(_CREATED)


def scratch_since(mark: int) -> list[str]:
    return _CREATED[mark:]


def drop_scratch(spark, paths: list[str]) -> None:
    """Delete scratch folders made by this package and no longer read."""
    for path in paths:
        if path in _CREATED:
            jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
            jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
            _CREATED[_CREATED.index(path)] = ""


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use``
    refers to it (a lambda variable cannot be inlined by the optimizer)."""
    return F.transform(F.array(value), use)[0]


def null_key(column: Column | str) -> Column:
    """A never-null string key that keeps null apart from every value."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n"))


def n_words(text: Column) -> Column:
    """Number of words in ``text``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    name, taken = stem, {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
