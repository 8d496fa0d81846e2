"""String column functions with the reference's Java semantics.

All functions build JVM-side expressions; no Python runs per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split(c: str | Column, sep: str = " ") -> Column:
    """``String.split(sep)`` for a literal separator.

    Java drops trailing empty strings but keeps leading and inner ones; an
    empty input gives one empty word, an input made only of separators gives
    none. Spark's ``split`` keeps trailing empties, so they are trimmed first.
    """
    s = _col(c)
    return java_split_trimmed(s, trim_trailing(s, sep), sep)


def trim_trailing(c: str | Column, sep: str = " ") -> Column:
    """The input without trailing separators (first half of ``java_split``)."""
    s = _col(c)
    if sep == " ":
        return F.rtrim(s)  # Spark's rtrim removes only U+0020
    return F.regexp_replace(s, f"(?:{re.escape(sep)})+$", "")


def java_split_trimmed(c: str | Column, trimmed: str | Column, sep: str = " ") -> Column:
    """``java_split`` given the input and its ``trim_trailing`` value, so a
    caller can project the trimmed text once and reuse it."""
    s, t = _col(c), _col(trimmed)
    return (F.when(s == "", F.array(F.lit("")))
            .when(t == "", F.array().cast("array<string>"))
            .otherwise(F.split(t, re.escape(sep), -1)))


def text_lines(c: str | Column) -> Column:
    """Lines of a text the way a line reader yields them: split on ``\\n``,
    no extra empty line after a final newline, no line for an empty text."""
    return drop_final_empty(F.split(_col(c), "\n", -1))


def drop_final_empty(arr: str | Column) -> Column:
    """Drop the last element of an array when it is the empty string."""
    a = _col(arr)
    return F.when(F.element_at(a, -1) == "", F.slice(a, 1, F.size(a) - 1)).otherwise(a)


def java_trim(c: str | Column) -> Column:
    """Java ``trim`` strips every char <= U+0020 at both ends."""
    return F.regexp_replace(_col(c), r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def base_name(path: str | Column) -> Column:
    """last ``/`` segment of a path."""
    return F.element_at(F.split(_col(path), "/"), -1)
