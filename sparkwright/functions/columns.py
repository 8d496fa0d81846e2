"""Column helpers for the reference's scalar and collection operations
(F2-F6, F8, F10, F11, F13-F23, P5, P8, P13). All are JVM-side expressions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: str | Column, den: str | Column, digits: int = 5) -> Column:
    """P5/F2: double division rounded HALF_UP."""
    return F.round(_col(num) / _col(den), digits)


def hour_floor(ts: str | Column) -> Column:
    """floor a timestamp to the hour."""
    return F.date_trunc("hour", _col(ts))


def days_before(as_of: str, days: int) -> Column:
    """``date 'as_of' - interval 'days' day`` with an explicit as-of date."""
    return F.date_sub(F.to_date(F.lit(as_of)), days)


def to_long(c: str | Column, lenient: bool = False) -> Column:
    """F8: ``Long.parseLong``: bad input fails the job whatever the session's
    ANSI setting (null stays null); lenient mode gives null instead."""
    x = _col(c)
    parsed = x.try_cast("long")
    if lenient:
        return parsed
    bad = F.raise_error(F.concat(F.lit("not a long: "), x.cast("string")))
    return F.when(parsed.isNull() & x.isNotNull(), bad).otherwise(parsed)


def find_all(c: str | Column, pattern: str, group: int = 0) -> Column:
    """all matches of a regex."""
    return F.regexp_extract_all(_col(c), F.lit(pattern), group)


def marker_token(r: Column) -> Column:
    """``g`` + ``e`` * r + ``k``."""
    return F.concat(F.lit("g"), F.repeat(F.lit("e"), r), F.lit("k"))


def json_string_array(c: str | Column, lenient: bool = False) -> Column:
    """JSON array text -> ``array<string>``. Null or malformed text fails
    the job, or gives null if ``lenient``."""
    x = _col(c)
    if lenient:
        return F.from_json(x, "array<string>")
    parsed = F.from_json(x, "array<string>")
    bad = F.raise_error(F.concat(F.lit("not a JSON array: "), F.coalesce(x, F.lit("null"))))
    return F.when(parsed.isNull(), bad).otherwise(parsed)


def null_or_empty(c: str | Column) -> Column:
    """null or empty string."""
    x = _col(c)
    return x.isNull() | (F.length(x) == 0)


def multiple_of(c: str | Column, m: int) -> Column:
    """``x % m == 0``."""
    return (_col(c) % m) == 0


def scale_array(arr: str | Column, factor) -> Column:
    """F16: ``array.map(_ * factor)``."""
    return F.transform(_col(arr), lambda x: x * factor)


def int_range(start, stop, step=1, inclusive: bool = True) -> Column:
    """``start to stop by step`` (inclusive) or ``until`` (exclusive)."""
    s, e, st = (F.lit(v) if not isinstance(v, Column) else v for v in (start, stop, step))
    if not inclusive:
        e = e - F.signum(st).cast("int")
    return F.sequence(s, e, st)


def concat_lists(a: str | Column, b: str | Column) -> Column:
    """``List.concat`` / ``:::``."""
    return F.concat(_col(a), _col(b))


def to_set(a: str | Column) -> Column:
    """de-duplicated array (first occurrence order)."""
    return F.array_distinct(_col(a))


def lookup(map_col: str | Column, key: str | Column, default: str) -> Column:
    """map lookup with a default for a missing key."""
    k = F.lit(key) if isinstance(key, str) and not key.startswith("`") else key
    return F.coalesce(F.try_element_at(_col(map_col), k), F.lit(default))


def case_map(c: str | Column, cases: Mapping, default) -> Column:
    """``x match { case a => ...; case _ => default }``."""
    x = _col(c)
    expr = None
    for k, v in cases.items():
        expr = F.when(x == F.lit(k), F.lit(v)) if expr is None else expr.when(x == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def mk_string(arr: str | Column, start: str = "Array(", sep: str = ", ", end: str = ")") -> Column:
    """``mkString(start, sep, end)``."""
    return F.concat(F.lit(start), F.array_join(_col(arr).cast("array<string>"), sep), F.lit(end))


def name_prefix(c: str | Column, prefix: str = "Name: ") -> Column:
    """``"Name: " + value``; a null value prints as ``null`` (Java concat)."""
    return F.concat(F.lit(prefix), F.coalesce(_col(c).cast("string"), F.lit("null")))


def joined_fields(sep: str, fields: list[Column]) -> Column:
    """Fields as text with ``sep`` between them; a null is an empty field, so
    the fields after it keep their places."""
    return F.concat_ws(sep, *[F.coalesce(f.cast("string"), F.lit("")) for f in fields])
