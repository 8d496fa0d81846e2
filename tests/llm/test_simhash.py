"""SimHash against brute force over all pairs."""

import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sparkwright.llm import simhash


def plain_fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, bits):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= bits:
            parent[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_every_set_of_equal_positions_holds_a_key():
    for bits in range(8):
        for size in (1, 2, 3, 4):
            sets = [set(s) for s in simhash.position_sets(bits, size)]
            assert all(any(s <= set(c) for s in sets)
                       for c in itertools.combinations(range(8), 8 - bits))
    assert len(simhash.position_sets(4, 3)) == 20


@pytest.mark.parametrize("text", [None, "", " \n\t", "a", "A b", "one two three four",
                                  "é Ü x\x0by\x1cz w v u a b c", "x " * 70000])
def test_fingerprint(text):
    assert simhash.fingerprint(text, 4) & (2 ** 64 - 1) == plain_fingerprint(text)


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefghij") + rng.choice("klmno") for _ in range(60))
            for _ in range(30)]
    texts = [None, "", "a b", "a b"]
    for t in base:
        for _ in range(4):
            w = t.split()
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = "zz"
            texts.append(" ".join(w))
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (None, "own words here now ok")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash"))
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    fps = [plain_fingerprint(t) for _, t in rows]
    group = plain_components(fps, 4)
    least = {}
    for g, (i, _) in zip(group, rows):
        least[g] = min(x for x in (least.get(g), i) if x is not None) \
            if (i is not None or least.get(g) is not None) else None
    want = sorted((str(i), f, str(least[g])) for (i, _), f, g in zip(rows, fps, group))
    assert sorted((str(r.doc_id), r.fp & (2 ** 64 - 1), str(r.component_id)) for r in got) == want
    kept = simhash.keep_one_per_group(df).collect()
    assert len(kept) == len(set(group)) and set(kept[0].asDict()) == {"doc_id", "text", "fp"}


@pytest.mark.parametrize("bits", [4, 3])
def test_long_posting_lists_lose_no_link(spark, bits):
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 2 ** 63, 3, dtype=np.int64)
    fps = {int(c) ^ sum(1 << int(b) for b in rng.choice(20, rng.integers(0, 5), replace=False) + 30)
           for c in centre for _ in range(60)} | {int(x) for x in rng.integers(0, 2 ** 63, 200)}
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = [(r.a, r.b) for r in simhash.fingerprint_links(df, bits, list_max=10).collect()]
    group = plain_components(fps, bits)
    at = {f: i for i, f in enumerate(fps)}
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in links:
        parent[find(at[a])] = find(at[b])
    same = [find(i) for i in range(len(fps))]
    assert len(set(same)) == len(set(group)) == len(set(zip(same, group)))


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).count() == 0
    assert simhash.keep_one_per_group(df).count() == 0


@pytest.mark.parametrize("max_bits", [5, 7])
def test_odd_limits_above_three_are_refused(spark, max_bits):
    fps = spark.createDataFrame([(1,), (2,)], "fp long")
    with pytest.raises(ValueError, match="at most 3 or even"):
        simhash.fingerprint_links(fps, max_bits)
