"""Substring dedup by hashing lines and the sentences and runs inside them.

A text is cut into pieces at line and sentence ends. Copied passages are often
pasted into the middle of a line, so whole lines alone would miss them; a piece
also ends before a capitalised word, as that is how a pasted passage begins. A
sentence of more than ``LONG`` words is cut where the hash of two words is the
smallest of ``WINDOW``: the same places in every copy of a run, and one at least
in every ``WINDOW`` words. A unit is a piece of at least ``min_words`` words, or a
shorter one with as many of its followers as it takes to reach that: fewer
words are too common to be evidence. In scripts without spaces a character is
half a word. Every line of at least ``MIN_CHARS`` characters is a unit too. Units
are normalised (lower case, white space as one space) and hashed to 128 bits.
Digests are grouped globally; the occurrence that ranks first (by doc_id, then
text hash, then place) stays and all others go, with all their pieces.

One scan emits narrow rows (digest, document, start and end). A count by one half
of the digest tells which can repeat, and only their rows are kept for the search
for first places (a partial aggregate) and the join that finds what to remove. Texts
are shuffled once, to meet the offsets of their removed units; they are cut into
pieces in the scan alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.llm.common import drop_scratch, materialise, scratch_mark, scratch_since

MIN_WORDS = 8
#: Least characters of a line that is a unit, whatever its words.
MIN_CHARS = 24
#: A sentence of more words is cut at one place at least in every WINDOW words.
LONG, WINDOW = 25, 12
#: An odd multiplier: the key of two words depends on their order.
_PAIR = np.uint64(0x9E3779B97F4A7C15)

#: End marks of scripts other than Latin.
_STOPS = "。！？｡؟۔।॥።"
# A set of first characters lets the search skip quickly; what must follow hangs on which it was.
_PIECE_END = re.compile(
    rf"(?:[\n.!?{_STOPS}]|[ ](?=[^\W\d_a-zß-öø-ÿ]))"
    rf"(?:(?<=\n)\n*|(?<=[.!?])[^\w\s]*[ \t]+|(?<=[{_STOPS}])[{_STOPS}]*[^\w\s]*[ \t]*|(?<= ))")
#: Characters of scripts without spaces: Thai, Lao, Tibetan, Burmese, Khmer, Kana, Han.
_ALONE = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_SOLE = re.compile(f"[{_ALONE}]")
_TOKEN = re.compile(f"[{_ALONE}]|[^\\s{_ALONE}]+")
_LINE = re.compile(r"[^\n]+\n*")


def spaced(text: str) -> bool:
    """Whether a text has no character of a script without spaces."""
    return text.isascii() or not _SOLE.search(text)


def tokens(text: str, plain: bool = False) -> list[str]:
    """Normalised words; a character of a script without spaces is one.
    ``plain`` says that there is none."""
    low = text.lower()
    return low.split() if plain or spaced(low) else _SOLE.sub(r" \g<0> ", low).split()


def n_words(words: list[str]) -> float:
    """How many words; a character of a script without spaces is half of one."""
    return len(words) - sum(1 for w in words if len(w) == 1 and _SOLE.match(w)) / 2


def cuts(text: str, start: int, end: int, plain: bool = False) -> list[int]:
    """Offsets at which a long sentence is cut, by the words around alone."""
    if end - start <= (2 * LONG if plain else LONG):
        return []
    part = text[start:end]
    if (plain or spaced(part)) and len(part.split()) <= LONG:
        return []
    found = list(_TOKEN.finditer(part))
    if len(found) <= LONG:
        return []
    one = np.array([xxhash.xxh64_intdigest(m.group().lower()) for m in found], np.uint64)
    keys = one[:-1] * _PAIR ^ one[1:]
    if len(keys) > 4096:  # a view; for the usual few, gathering them is quicker
        windows = np.lib.stride_tricks.sliding_window_view(keys, WINDOW)[:, ::-1]
    else:
        windows = keys[np.arange(WINDOW - 1, -1, -1) + np.arange(len(keys) - WINDOW + 1)[:, None]]
    # Of equal smallest hashes the last counts.
    least = np.arange(len(windows)) + WINDOW - 1 - windows.argmin(1)
    return [start + found[i].start() for i in sorted(set(least.tolist())) if i]


def pieces(text: str) -> list[tuple[int, int]]:
    """(start, end) code point offsets of a text's pieces, in order.

    Ends lie after the white space that follows, so the pieces tile the text.
    A break between two words counts only if the second has a capital letter.
    """
    out, start, plain = [], 0, spaced(text)
    ends = [m.end() for m in _PIECE_END.finditer(text)
            if m.group() != " " or text[m.end()].isupper()]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    for end in ends:
        for cut in cuts(text, start, end, plain):
            out.append((start, cut))
            start = cut
        if start < end:
            out.append((start, end))
        start = end
    return out


def units(text: str, min_words: int) -> Iterator[tuple[int, int, str]]:
    """(start, end, normalised words) of each unit. A piece without words starts
    none, and neither do the last pieces if they fall short."""
    places, norm, size, plain = pieces(text), [], [], spaced(text)
    for a, b in places:
        words = tokens(text[a:b], plain)
        norm.append(" ".join(words))
        size.append(len(words) if plain else n_words(words))
    end, total = 0, 0
    for first, own in enumerate(norm):
        while total < min_words and end < len(norm):
            total += size[end]
            end += 1
        if total < min_words:
            break
        if own:
            yield (places[first][0], places[end - 1][1],
                   own if end == first + 1 else " ".join(filter(None, norm[first:end])))
        total -= size[first]


def lines(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, normalised text) of each line of enough characters."""
    for m in _LINE.finditer(text):
        line = " ".join(m.group().lower().split())
        if len(line) >= MIN_CHARS:
            yield m.start(), m.end(), line


def _unit_rows(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, starts, ends, digests = [], [], [], []
            for i, t in enumerate(b.column("text").to_pylist()):
                # Apart from the pieces: a line of one piece would repeat it.
                own = [(s, e, "\n" + line) for s, e, line in lines(t or "")]
                for start, end, key in chain(own, units(t or "", min_words)):
                    row.append(i)
                    starts.append(start)
                    ends.append(end)
                    digests.append(xxhash.xxh3_128_digest(key.encode("utf-8", "replace")))
            take = pa.array(row, pa.int64())
            halves = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(take), b.column("text_hash").take(take),
                 pa.array(starts, pa.int32()), pa.array(ends, pa.int32()),
                 pa.array(halves[:, 0]), pa.array(halves[:, 1])],
                names=["doc_id", "text_hash", "start", "end", "high", "low"])
    return run


def merged_spans(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans that ``found`` cover together, in order."""
    spans: list[list[int]] = []
    for a, b in sorted(found):
        if spans and spans[-1][1] >= a:
            spans[-1][1] = max(b, spans[-1][1])
        else:
            spans.append([a, b])
    return [(a, b) for a, b in spans]


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for b in batches:
        spans, texts = [], b.column("_text")
        changed = {}
        for i, gone in enumerate(b.column("_gone").to_pylist()):
            found = merged_spans([(g["start"], g["end"]) for g in gone or ()])
            if found:
                t, kept, at = texts[i].as_py(), [], 0
                for a, e in found:
                    kept.append(t[at:a])
                    at = e
                changed[i] = "".join([*kept, t[at:]])
            spans.append([{"start": a, "end": e} for a, e in found])
        if changed:
            texts = pa.array([changed[i] if i in changed else t
                              for i, t in enumerate(texts.to_pylist())], pa.string())
        rest = [n for n in b.schema.names if n != "_gone"]
        columns = [texts if n == "_text" else b.column(n) for n in rest]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, span)], names=[*rest, "_spans"])


def duplicate_units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_hash, start, end) of every unit that repeats an earlier one."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    mark = scratch_mark()
    found = materialise(rows.mapInArrow(
        _unit_rows(min_words),
        f"doc_id {id_type}, text_hash long, start int, end int, high long, low long"), "units")
    # Counting one half of each digest moves the least; the few rows left are told apart by both.
    halves = materialise(found.groupBy("high").agg(F.count(F.lit(1)).alias("n"))
                         .filter("n > 1").select("high"), "repeated-halves")
    again = materialise(found.join(halves, "high", "left_semi"), "repeated-units")
    drop_scratch(docs.sparkSession, scratch_since(mark)[:-1])
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "start")
    # A table of its own: a join straight after a shuffle of rows is one that a hot key can be split in.
    first = materialise(again.groupBy("high", "low").agg(F.min(place).alias("first")), "first-places")
    return (again.join(first, ["high", "low"]).filter(place != F.col("first"))
            .select("doc_id", "text_hash", "start", "end"))


def substring_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated units cut from ``text``, and ``removed_spans``
    (array of start, end): code point offsets into the original text.

    A document is known by doc_id and text, so rows that repeat both are one
    document and stay alike. A null doc_id ranks last. Null and empty texts stay
    as they are, very long ones are read whole, and an empty table gives no rows.
    A text made of repeats only becomes empty. If the input has a column
    ``removed_spans`` the new one gets a leading underscore.
    """
    names, mark = docs.columns, scratch_mark()
    gone = materialise(
        duplicate_units(docs, min_words).distinct().groupBy("doc_id", "text_hash")
        .agg(F.collect_list(F.struct("start", "end")).alias("_gone"))
        .select(F.col("doc_id").alias("_gid"), F.col("text_hash").alias("_ghash"), "_gone"),
        "removed-units")
    drop_scratch(docs.sparkSession, [p for p in scratch_since(mark)[:-1] if p])
    keyed = docs.select(*[F.col(c).alias("_text" if c == "text" else f"c{i}")
                          for i, c in enumerate(names)],
                        F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"))
    # The narrow side is hashed, so texts aren't sorted for the join.
    joined = (keyed.join(gone.hint("shuffle_hash"), F.col("_id").eqNullSafe(F.col("_gid"))
                         & (F.col("_hash") == F.col("_ghash")), "left")
              .drop("_gid", "_ghash", "_id", "_hash"))
    fields = [f for f in joined.schema if f.name != "_gone"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    out = joined.mapInArrow(_cut_rows, f"{schema}, _spans array<struct<start:int,end:int>>")
    spans = "removed_spans"
    while spans in names:
        spans = "_" + spans
    return out.select(*[F.col("_text" if c == "text" else f"c{i}").alias(c)
                        for i, c in enumerate(names)], F.col("_spans").alias(spans))
