"""Licence scan against an alignment at every word, and planted notices."""

import random

import duckdb
from pyspark.sql import functions as F

from sparkwright.llm import license_scan as ls
from sparkwright.llm.license_templates import TEMPLATES

INDEX = ls.Index(TEMPLATES)


def everywhere(text):
    """The scan with every template tried at every word."""
    n = len(ls.words_of(text))
    return ls.scan_text(INDEX, text, candidates=[
        (t, s) for t in range(len(INDEX.names)) for s in range(n)])


def planted(seed):
    rng = random.Random(seed)
    filler = lambda n: " ".join(rng.choice(
        ["the", "of", "thing", "license", "anea", "to", "public", "under", "erent"]) for _ in range(n))
    out = []
    for name in sorted(TEMPLATES):
        words = TEMPLATES[name].split()
        for _ in range(2):
            w = list(words)
            for _ in range(rng.randint(0, len(w) // 12)):
                k = rng.randrange(len(w))
                w[k:k + 1] = rng.choice([[], ["another"], [w[k], "more"]])
            out.append((name, f"{filler(rng.randint(0, 40))}\n{' '.join(w)}\n{filler(30)}"))
    return out


def test_finds_what_a_scan_at_every_word_finds():
    for name, text in planted(4):
        got, full = ls.scan_text(INDEX, text), everywhere(text)
        assert got == full, name
        assert got, name


def common(a, b):
    """Words that two lists have in common in order, by the whole table."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_coverage_and_spans_equal_a_plain_alignment():
    checked = 0
    for name, text in planted(11):
        words, low = ls.words_of(text), text.lower()
        for got, coverage, a, b in ls.scan_text(INDEX, text):
            template = ls.words_of(TEMPLATES[got])
            if len(template) > 400:
                continue
            span = ls.words_of(low[a:b])
            before = len(ls.words_of(low[:a]))
            assert span == words[before:before + len(span)]
            matched = common(template, span)
            assert matched == round(coverage * len(template)) >= 0.8 * len(template)
            # The span begins and ends with matched words.
            assert common(template, span[1:]) < matched > common(template, span[:-1])
            checked += 1
    assert checked > 20


def test_every_run_of_kept_words_holds_a_fingerprint():
    for t, words in enumerate(INDEX.words):
        need = INDEX.need(t, 0.8)
        missing = len(words) - need
        window = -(-need // (missing + 1))
        places = sorted(p for own in INDEX.fingerprints(t, 0.8).values() for p in own)
        assert all(words[p] == w for w, own in INDEX.fingerprints(t, 0.8).items() for p in own)
        gaps = [b - a for a, b in zip([-1, *places], [*places, len(words)])]
        assert max(gaps) <= window  # fewer than ``window`` words between two of them


def test_short_notices_with_one_word_changed_dropped_or_added():
    found = 0
    for name in sorted(TEMPLATES):
        words = TEMPLATES[name].split()
        if len(words) > 30:
            continue
        for k in range(len(words)):
            for new in (["another"], [], [words[k], "more"]):
                body = " ".join([*words[:k], *new, *words[k + 1:]])
                text = f"some words before it\n{body}\nand some after"
                got = ls.scan_text(INDEX, text)
                assert got == everywhere(text), (name, body)
                found += bool(got)
    assert found > 50
    for name, text in (("MIT", "Licensed under the MIT License."),
                       ("Apache-2.0", "Licensed under Apache License, Version 2.0.")):
        assert [h[0] for h in ls.scan_text(INDEX, text)] == [f"notice:{name}"]


def test_whole_texts_and_near_equal_templates():
    whole = {n: " ".join(TEMPLATES[n].split()) for n in TEMPLATES}
    for name, end in (("MIT", "DEALINGS IN THE SOFTWARE"), ("BSD-2-Clause", "SUCH DAMAGE"),
                      ("BSD-3-Clause", "SUCH DAMAGE"), ("ISC", "PERFORMANCE OF THIS SOFTWARE")):
        text = f"Copyright someone. {whole[name]} And code."
        ((got, coverage, a, b),) = ls.scan_text(INDEX, text)
        assert got == name and coverage == 1.0 and text[a:b].endswith(end)
        lacking = f"Copyright someone. {whole['part:' + name]} And code."
        assert [h[0] for h in ls.scan_text(INDEX, lacking)] == [f"part:{name}"]
    for name in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0"):
        for kind in (name, f"{name}:address", f"part:{name}"):
            text = f"x {whole[kind].replace('useful', 'of use')} y"
            assert [h[0] for h in ls.scan_text(INDEX, text)] == [kind]
    assert ls.scan_text(INDEX, whole["MPL-2.0"])[0][0] == "MPL-2.0"


def test_no_run_of_words_needs_to_stay():
    for name in sorted(TEMPLATES):
        words = ls.words_of(TEMPLATES[name])
        # Another word after every second one: 2 of 3 words of the span.
        text = "so " + " ".join(w + " zz" * (k % 2) for k, w in enumerate(words)) + " then"
        got = ls.scan_text(INDEX, text)
        assert got == everywhere(text), name


def test_exact_notices_and_spans():
    for name, text in TEMPLATES.items():
        body = " ".join(text.split())
        doc = f"İntro words.\n{body}\nand more words, ß"
        (hit,) = ls.scan_text(INDEX, doc)
        assert hit[0] == name and hit[1] == 1.0
        assert ls.words_of(doc[hit[2]:hit[3]]) == ls.words_of(body)


def test_clean_text_and_edge_cases():
    assert ls.scan_text(INDEX, "the license of all things under the public version") == []
    assert ls.scan_text(INDEX, "") == [] and ls.scan_text(INDEX, "...") == []
    twice = "All rights reserved. " + "x " * 50 + "All rights reserved."
    assert [h[0] for h in ls.scan_text(INDEX, twice)] == ["notice:all-rights-reserved"] * 2


def test_documents(spark):
    rows = [(i, t) for i, (_, t) in enumerate(planted(2))] + [(3, planted(2)[3][1]), (900, None), (901, ""),
            (None, "Released under the MIT License."), (902, "y " * 200_000 + "All rights reserved.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("license", F.lit("clash"))
    got = sorted(str(tuple(r)) for r in ls.license_scan(df).collect())
    want = sorted(str((i, *h)) for i, t in rows if t for h in ls.scan_text(INDEX, t))
    assert got == want and ls.license_scan(df.limit(0)).count() == 0


def test_whole_table_equals_a_scan_at_every_word(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    texts = duckdb.execute(f"select doc_id, text from '{path}' where length(text) < 1500").fetchall()
    df = spark.read.parquet(path).filter(F.length("text") < 1500)
    got = sorted(map(tuple, ls.license_scan(df).collect()))
    assert got == sorted((i, *h) for i, t in texts for h in everywhere(t)) and got
