"""Marker-text encoding (K8) and decoding (S15) as column expressions.

Encoding: the line is split into words with Java ``split(" ")`` rules, every
word is followed by one space, and after the words at index r, 2r, 3r, ...
a token ``g`` + ``e`` * r + ``k`` and a space are inserted, with r in
2..255. The reference draws r at random, and draws a new r after every
token; here one r per line comes from a hash of the line, so a rerun (or a
retried task) writes the same bytes. Both are valid files of the format:
each token's ``e`` count is its gap, and decoding does not depend on it.

Decoding: ``compat`` deletes every ``gee+k`` (the reference reader; it
leaves the spaces around a token). ``clean`` deletes every ``gee+k `` and
then one trailing space, which restores the line exactly when it had no
trailing spaces and no word matching ``gee+k``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkwright.functions.columns import marker_token
from sparkwright.functions.text import java_split

# Fixed values of the format: gap range 2..255 (254 choices) and the token pattern.
GAP_MIN = 2
GAP_CHOICES = 254
TOKEN_PATTERN = "gee+k"


def marker_gap(c: Column) -> Column:
    """Per-line gap r = 2 + pmod(xxhash64(line), 254)."""
    return F.pmod(F.xxhash64(c), F.lit(GAP_CHOICES)) + F.lit(GAP_MIN)


def marker_encode(c: str | Column, gap: int | Column | None = None) -> Column:
    s = F.col(c) if isinstance(c, str) else c
    r = marker_gap(s) if gap is None else (F.lit(gap) if isinstance(gap, int) else gap)
    words = java_split(s, " ")
    pieces = F.transform(words, lambda w, i: F.concat(
        w, F.lit(" "),
        F.when((i > 0) & (i % r == 0), F.concat(marker_token(r), F.lit(" "))).otherwise(F.lit(""))))
    return F.array_join(pieces, "")


def marker_decode(c: str | Column, mode: str = "clean") -> Column:
    s = F.col(c) if isinstance(c, str) else c
    if mode == "compat":
        return F.regexp_replace(s, TOKEN_PATTERN, "")
    if mode == "clean":
        return F.regexp_replace(F.regexp_replace(s, TOKEN_PATTERN + " ", ""), " \\z", "")
    raise ValueError("mode must be 'compat' or 'clean'")
