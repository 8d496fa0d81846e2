"""Substring dedup against a plain one-process version."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from sparkwright.llm import substring_dedup as sd


def text_hash(t):
    return 42 if t is None else int(np.array([xxhash.xxh64_intdigest(t.encode(), 42)],
                                             np.uint64).view(np.int64)[0])


def alone(c):
    """A character of a script without spaces."""
    p = ord(c)
    return any(a <= p <= b for a, b in (
        (0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x9FFF),
        (0xF900, 0xFAFF), (0x20000, 0x3FFFF)))


def plain_tokens(text):
    """[(start, word)] of a text, character by character."""
    out, at = [], None
    for i, c in enumerate(text + " "):
        if at is not None and (c.isspace() or alone(c)):
            out.append((at, text[at:i]))
            at = None
        if i < len(text) and alone(c):
            out.append((i, c))
        elif i < len(text) and not c.isspace() and at is None:
            at = i
    return out


def plain_ends(text):
    """Offsets behind line ends, sentence ends and blanks before a capital."""
    ends, i, n = [], 0, len(text)

    def run(j, ok):
        while j < n and ok(text[j]):
            j += 1
        return j
    mark = lambda c: not (c.isalnum() or c == "_" or c.isspace())
    while i < n:
        end = None
        if text[i] == "\n":
            end = run(i, "\n".__eq__)
        elif text[i] in ".!?":
            stop = run(i + 1, mark)
            end = run(stop, " \t".__contains__)
            end = end if end > stop else None
        elif text[i] in "。！？｡؟۔।॥።။":
            end = run(run(i, mark), " \t".__contains__)
        elif text[i] == " " and i + 1 < n and text[i + 1].isupper() and text[i + 1].isalnum():
            end = i + 1
        if end:
            ends.append(end)
        i = end or i + 1
    return ends


def plain_pieces(text):
    out, start = [], 0
    for end in [*plain_ends(text), len(text)]:
        if end <= start:
            continue
        words = plain_tokens(text[start:end])
        places = set()
        if len(words) > 25:
            one = [xxhash.xxh64_intdigest(w.lower()) for _, w in words]
            keys = [(a * 0x9E3779B97F4A7C15 % 2 ** 64) ^ b for a, b in zip(one, one[1:])]
            for k in range(len(keys) - 11):  # the last of the smallest of 12
                least = min(keys[k:k + 12])
                places.add(max(j for j in range(k, k + 12) if keys[j] == least))
        for j in sorted(places):
            if j:
                out.append((start, start + words[j][0]) if not out or out[-1][1] <= start
                           else (out[-1][1], start + words[j][0]))
        out.append((max(start, out[-1][1] if out else 0), end))
        start = end
    return out


def plain_units(text, min_words):
    """(start, end, key) of every unit: whole lines, and pieces with their followers."""
    out, at = [], 0
    while at < len(text):  # lines with the newlines behind them
        end = at
        while end < len(text) and text[end] != "\n":
            end += 1
        stop = end
        while stop < len(text) and text[stop] == "\n":
            stop += 1
        words = " ".join(text[at:end].lower().split())
        if end > at and len(words) >= 24:
            out.append((at, stop, ("line", words)))
        at = stop
    parts = plain_pieces(text)
    words = [[w for _, w in plain_tokens(text[a:b].lower())] for a, b in parts]
    count = [sum(0.5 if len(w) == 1 and alone(w) else 1 for w in ws) for ws in words]
    for k in range(len(parts)):
        end = k
        while end < len(parts) and sum(count[k:end]) < min_words:
            end += 1
        if words[k] and sum(count[k:end]) >= min_words:
            out.append((parts[k][0], parts[end - 1][1], ("piece", " ".join(sum(words[k:end], [])))))
    return out


def plain(rows, min_words):
    """By the definition: the first occurrence of a unit by (doc_id, text hash,
    place) stays; keys are compared as strings."""
    seen, found = {}, {}
    for i, t in set(rows):
        found[i, t] = plain_units(t or "", min_words)
        for start, _, key in found[i, t]:
            place = (i is None, i or 0, text_hash(t), start)
            seen[key] = min(seen.get(key, place), place)
    out = []
    for i, t in rows:
        gone = [False] * len(t or "")
        for start, end, key in found[i, t]:
            if (i is None, i or 0, text_hash(t), start) != seen[key]:
                gone[start:end] = [True] * (end - start)
        spans, kept = [], t
        for k, g in enumerate(gone):
            if g and spans and spans[-1][1] == k:
                spans[-1] = (spans[-1][0], k + 1)
            elif g:
                spans.append((k, k + 1))
        if spans:
            kept = "".join(c for c, g in zip(t, gone) if not g)
        out.append((str(i), str(kept), str(spans)))
    return sorted(out)


def test_pieces_tile_the_text():
    t = "One two. Three four!%% \n\nFive six seven Eight nine.  Ten\tÉcole über Übung\n"
    u = sd.pieces(t)
    assert "".join(t[a:b] for a, b in u) == t
    assert [t[a:b].strip() for a, b in u] == [
        "One two.", "Three four!%%", "", "Five six seven", "Eight nine.", "Ten\tÉcole über", "Übung"]
    assert sd.pieces("") == []


def test_pieces_and_units_equal_the_plain_ones():
    rng = random.Random(5)
    bits = ["a", "bé", "Ünd", "ß", "Ⅷ", "Ⓐ", "x_1", "9", ".", "!", "?\"", "。", "॥", "\n", "\n\n", " ", " ", " ",
            "  ", "\t", "中", "文字", "ไทย", ".\u00a0", "İ", "\x1c", "% ", "It", "longword"]
    for n in [*range(0, 60, 3), 400, 3000]:
        text = "".join(rng.choices(bits, k=n))
        assert sd.pieces(text) == plain_pieces(text)
        got = [(a, b, ("line", w)) for a, b, w in sd.lines(text)]
        got += [(a, b, ("piece", w)) for a, b, w in sd.units(text, 8)]
        assert got == plain_units(text, 8)
    long = " ".join(f"w{rng.randrange(300)}" for _ in range(9000))
    assert sd.pieces(long) == plain_pieces(long)


def test_equals_plain_version(spark):
    passage = " ".join(f"Start {j} of a sentence that has ten words in it, end." for j in range(6))
    rows = [(3, f"own words here before {passage} and after it all"), (1, f"other beginning {passage}"),
            (2, passage), (2, passage), (2, "another text under an id that is taken by some row."),
            (None, passage), (None, None), (5, None), (4, ""), (6, "short one. " * 50),
            (7, "UPPER and  lower case are the SAME line here\nand this is another line of text"),
            (8, "upper and lower\tcase are the same line here\nnothing else"),
            (9, "x " * 3_000 + "\n" + passage)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("unit", F.lit(1)) \
        .withColumn("removed_spans", F.lit("clash"))
    got = sd.substring_dedup(df).collect()
    assert got[0].removed_spans == "clash" and got[0].unit == 1
    have = sorted((str(r.doc_id), str(r.text), str([tuple(s) for s in r._removed_spans])) for r in got)
    assert have == plain(rows, sd.MIN_WORDS)
    by_id = {r.doc_id: r.text for r in got if r.doc_id in (1, 3, 9)}
    assert passage in by_id[1] and "sentence" not in by_id[3] and "sentence" not in by_id[9]


def test_short_pieces_count_with_their_followers():
    t = "Own. One two. Three. Four five six. Seven eight nine. Ten."
    assert [t[a:b] for a, b, _ in sd.units(t, 8)] == [
        "Own. One two. Three. Four five six. Seven eight nine. ",
        "One two. Three. Four five six. Seven eight nine. ", "Three. Four five six. Seven eight nine. Ten."]
    passage = " ".join(f"Part {'abcdefghijkl'[j]} of it." for j in range(12))
    rows = [(1, f"First text says this and that: {passage} Bye."), (2, f"another beginning {passage} The end.")]
    kept = {i: t for i, t, _ in plain(rows, 8)}
    assert passage in kept["1"] and kept["2"].startswith("another beginning") and "Part" not in kept["2"]


def test_runs_without_ends_and_lines_of_any_script(spark):
    run = " ".join(f"w{j * 7919 % 1009}" for j in range(60))
    chinese = "".join(chr(0x4E00 + j * 7919 % 5000) for j in range(80))
    line, short = "一二三四五六七八九十甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳", "Subscribe to our weekly letter"
    own = lambda c, n: " ".join(f"{c}{j}" for j in range(n))
    rows = [(1, f"{own('a', 40)} {run} {own('b', 40)}"), (2, f"{own('c', 33)} {run} {own('d', 27)}"),
            (3, f"甲乙{chinese}丙丁"), (4, f"子丑寅{chinese}卯"),
            (5, f"{line}\nfirst follower"), (6, f"{line}\nanother one"),
            (7, f"{short}\nfollowed by this"), (8, f"{short}\nthen by that")]
    got = {r.doc_id: r for r in sd.substring_dedup(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in (1, 3, 5, 7):
        assert got[i].text == rows[i - 1][1]
    assert sum(w in run.split() for w in got[2].text.split()) <= 35 and own("c", 33) in got[2].text
    assert own("d", 27) in got[2].text and len(got[4].text) < 60
    assert got[6].text == "another one" and got[8].text == "then by that"


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert sd.substring_dedup(df).count() == 0
