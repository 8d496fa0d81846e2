"""Licence scan: winnowed template fingerprints, then banded alignment.

A match may lack a fifth of a template's words and have others between any two
that stay, so no run of the text is sure to be a run of the template; but the
words that stay fall into at most one run of template words more than words are
missing. Of ``need`` words that stay, with at most ``m`` missing, some run has
ceil(need / (m + 1)) words. Templates are winnowed with windows of that many
words: in each the word with the smallest key (what few templates have, then the
smallest hash; the last of equals) is a fingerprint, so every match holds one. An
inverted index holds the fingerprints with their places. It depends on the
templates alone, so it is a few hundred kilobytes however large the corpus is.

A text's words are looked up in the index; a hit gives the word at which its
template would start. A hit counts if enough of the template's words lie in
reach of it, and in order (the longest common subsequence, by bit operations).
A banded alignment of the template with the text at every start in reach of
such a hit counts the template's words that occur in order and gives their
span. No step before it drops a start at which it would succeed. No rows are
exchanged: a text meets all templates where it is read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.llm.license_templates import TEMPLATES

#: Least number of words of a template.
LEAST = 3
#: Least part of a template's words that must be matched, and of the span's words.
MIN_COVERAGE, MIN_DENSITY = 0.8, 0.6

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Index:
    """Templates as words, and the inverted index of their fingerprints."""

    def __init__(self, templates: Mapping[str, str]):
        self.names = sorted(templates)
        self.words = [words_of(templates[n]) for n in self.names]
        if any(len(w) < LEAST for w in self.words):
            raise ValueError(f"a template needs at least {LEAST} words")
        #: word -> [(template, how often it has the word)]
        self.uses: dict[str, list[tuple[int, int]]] = defaultdict(list)
        #: Per template: word -> bits of its places.
        self.bits: list[dict[str, int]] = []
        for t, ws in enumerate(self.words):
            bits: dict[str, int] = defaultdict(int)
            for i, w in enumerate(ws):
                bits[w] |= 1 << i
            self.bits.append(dict(bits))
            for w, k in Counter(ws).items():
                self.uses[w].append((t, k))
        self.uses = dict(self.uses)
        self._winnowed: dict[tuple[int, float], dict[str, list[int]]] = {}

    def band(self, template: int) -> int:
        return max(3, len(self.words[template]) // 8)

    def need(self, template: int, min_coverage: float) -> int:
        """Least number of words that a match has."""
        return math.ceil(min_coverage * len(self.words[template]))

    def fingerprints(self, template: int, min_coverage: float) -> dict[str, list[int]]:
        """The template's winnowed words with their places."""
        if (template, min_coverage) not in self._winnowed:
            ws, need = self.words[template], self.need(template, min_coverage)
            window = max(1, math.ceil(need / (len(ws) - need + 1)))
            key = [(len(self.uses[w]), xxhash.xxh64_intdigest(w), -i) for i, w in enumerate(ws)]
            places = {-min(key[i:i + window])[2] for i in range(len(ws) - window + 1)}
            found: dict[str, list[int]] = defaultdict(list)
            for p in sorted(places):
                found[ws[p]].append(p)
            self._winnowed[template, min_coverage] = dict(found)
        return self._winnowed[template, min_coverage]

    def room(self, counts: Mapping[str, int]) -> dict[int, int]:
        """How many words of each template a text has, in any order."""
        room: dict[int, int] = defaultdict(int)
        for w, have in counts.items():
            for t, k in self.uses.get(w, ()):
                room[t] += min(k, have)
        return room

    def in_order(self, template: int, words: Iterable[str]) -> int:
        """Length of the longest common subsequence of template and words."""
        n, bits = len(self.words[template]), self.bits[template]
        full = left = (1 << n) - 1
        for w in words:
            m = bits.get(w)
            if m is not None:
                u = left & m
                left = (left + u | left - u) & full
        return n - left.bit_count()

    def candidates(self, words: list[str], min_coverage: float = MIN_COVERAGE) -> list[tuple[int, int]]:
        """(template, word at which it would start): every start at which an
        alignment can reach ``min_coverage``."""
        at: dict[str, list[int]] = defaultdict(list)
        for i, w in enumerate(words):
            if w in self.uses:
                at[w].append(i)
        room = self.room({w: len(places) for w, places in at.items()})
        out: list[tuple[int, int]] = []
        for t in sorted(room):
            need = self.need(t, min_coverage)
            if room[t] < need:
                continue
            template, band, starts = self.words[t], self.band(t), set()
            places = sorted(i for w in self.bits[t] for i in at.get(w, ()))
            for start in {i - p for w, own in self.fingerprints(t, min_coverage).items()
                          for i in at.get(w, ()) for p in own}:
                a = bisect_left(places, start - 2 * band)
                b = bisect_left(places, start + len(template) + 2 * band)
                if b - a >= need and self.in_order(t, (words[i] for i in places[a:b])) >= need:
                    starts.update(range(start - band, start + band + 1))
            out += [(t, start) for start in sorted(starts)]
        return out


def align(template: list[str], words: list[str], start: int, band: int) -> tuple[int, int, int]:
    """(matched, first, last): most template words found in order near the
    diagonal from ``start``, and the shortest such span of words.

    Template word i may meet words start + i - band to start + i + band.
    """
    # Cell j of a row: words up to start + i - band + j; (matched, first matched word).
    none = (0, -1)
    width = 2 * band + 1
    row: list[tuple[int, int]] = [none] * width
    best = (0, 0, -1)
    for i, word in enumerate(template):
        base, new = start + i - band, []
        for j in range(width):
            at = base + j
            cell = row[j + 1] if j + 1 < width else row[j]
            if j and new[j - 1] > cell:
                cell = new[j - 1]
            if 0 <= at < len(words) and words[at] == word:
                before = row[j]
                hit = (before[0] + 1, before[1] if before[0] else at)
                if hit > cell:
                    cell = hit
                    found = (hit[0], hit[1] - at, hit[1])
                    if found > best:
                        best = found
            new.append(cell)
        row = new
    matched, negative, first = best
    return matched, first, first - negative


def scan_text(index: Index, text: str, min_coverage: float = MIN_COVERAGE,
              min_density: float = MIN_DENSITY,
              candidates: list[tuple[int, int]] | None = None) -> list[tuple]:
    """(template name, coverage, start, end) of each licence found in a text;
    offsets are code points. Of overlapping spans that with most matched words
    less its template's missing ones stays (of equals that with most coverage,
    then the first by name), so the best coverage decides between near-equal
    templates and a whole text stands before a notice inside it."""
    words = words_of(text)
    if candidates is None:
        candidates = index.candidates(words, min_coverage)
    else:
        room = index.room(Counter(words))
        candidates = [(t, s) for t, s in candidates
                      if room.get(t, 0) >= index.need(t, min_coverage)]
    found, exact = set(), set()
    for t, start in candidates:
        n = len(index.words[t])
        if start >= 0 and words[start:start + n] == index.words[t]:
            exact.add((t, start))
            found.add((-n, -1.0, index.names[t], start, start + n - 1))
    for t, start in candidates:
        template, band = index.words[t], index.band(t)
        # Nothing in this band has more words than an exact copy inside it.
        if exact and any((t, s) in exact for s in range(start - band, start + band + 1)):
            continue
        near = words[max(0, start - band):max(0, start + len(template) + band)]
        if index.in_order(t, near) < index.need(t, min_coverage):
            continue
        matched, first, last = align(template, words, start, band)
        if matched >= min_coverage * len(template) and matched >= min_density * (last - first + 1):
            found.add((len(template) - 2 * matched, -matched / len(template),
                       index.names[t], first, last))
    kept: list[tuple] = []
    for _, coverage, name, first, last in sorted(found):
        if all(last < f or first > e for _, f, e, _ in kept):
            kept.append((name, first, last, -coverage))
    if not kept:
        return []
    offsets: list[int] = []
    low = text.lower()
    spans = [m.span() for m in _WORD.finditer(low)]
    if len(low) != len(text):  # lower-casing changed lengths: go back letter by letter
        for k, c in enumerate(text):
            offsets += [k] * len(c.lower())
        offsets.append(len(text))
        spans = [(offsets[a], offsets[b - 1] + 1) for a, b in spans]
    return sorted((name, coverage, spans[first][0], spans[last][1])
                  for name, first, last, coverage in kept)


def _scan(templates: dict[str, str], min_coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates)
        for b in batches:
            row, found = [], []
            for i, t in enumerate(b.column("text")):
                t = t.as_py()
                for hit in scan_text(index, t, min_coverage) if t else ():
                    row.append(i)
                    found.append(hit)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(row, pa.int64())),
                 pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()),
                 pa.array([f[2] for f in found], pa.int32()),
                 pa.array([f[3] for f in found], pa.int32())],
                names=["doc_id", "license", "coverage", "span_start", "span_end"])
    return run


def license_scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES,
                 min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """One row per licence occurrence: doc_id, license, coverage, span_start,
    span_end.

    ``coverage`` is the part of the template's words that the text has in order
    inside the span; spans are code point offsets into the text. Null and empty
    texts have no rows, very long ones are scanned whole; repeated rows are
    scanned each, and an empty table gives no rows. ``scan_text`` says which of
    overlapping spans stays. Other columns are not read.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text")).mapInArrow(
        _scan(dict(templates), min_coverage),
        f"doc_id {id_type}, license string, coverage double, span_start int, span_end int")
