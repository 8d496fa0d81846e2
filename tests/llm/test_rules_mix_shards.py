"""Quality rules, mixing and sharding against plain versions on edge cases."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sparkwright.llm import line_rules, mixing, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string"


def rows():
    line = "this line stands in many documents of one host "
    out = [(i, line * 3 + f"\nOwn words {i} " + " ".join(f"w{i}x{k}" for k in range(i * 6)), "a")
           for i in range(14)]
    out += [(20 + i, (line * 9 + "\n") * 2 + f"tail {i}", "b") for i in range(12)]
    out += [(50, None, "a"), (51, "", None), (52, " \t\n\x0b\x0c\r", "c"), (53, "a b a b a b", "c"),
            (54, "x #*$ <y> " * 30, None), (55, "z " * 30_000, "d"), (55, "z " * 30_000, "d"),
            (None, "null id text", "d"), (None, "null id text", "d"), (56, "é ü ß 漢字", "é"),
            (57, "Ünï " + " ".join(f"q{k}" for k in range(80)), "𝕏"), (7, "second row of an id", "a")]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).withColumns(
        {"size": F.lit("clash"), "key": F.lit(1), "shard": F.lit(9)}).repartition(5)


def plain_rules(data, max_docs=10):
    def lines(t):
        return [x for x in (t or "").split("\n") if WORD.search(x)]

    def norm(x):
        return re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[0-9]+", "0", x.lower())).strip(" ")
    held = defaultdict(set)
    for r, (_, t, s) in enumerate(data):
        for x in lines(t):
            held[s, norm(x)].add(r)
    out = []
    for i, t, s in data:
        t = t or ""
        w = WORD.findall(t)
        grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        many = Counter(grams)
        repeat = {k + d for k, g in enumerate(grams) if many[g] > 1 for d in range(3)}
        gone = sum(len(WORD.findall(x)) for x in lines(t) if len(held[s, norm(x)]) > max_docs)
        base = len(w) < 50 or 100 * len(repeat) > 50 * len(w)
        left = len(w) - gone
        out.append((str(i), len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t),
                    len(lines(t)) - len(set(lines(t))), len(repeat), base,
                    not base and left >= 50 and 2 * left >= len(w), gone))
    return sorted(out)


def test_quality_rules(docs):
    got = sorted((str(r[0]), *r[1:]) for r in line_rules.quality_rules(docs).collect())
    want = plain_rules(rows())
    assert got == want
    assert any(r[-1] and not r[6] and not r[7] for r in want) and any(r[7] for r in want)


def test_frequent_lines_leave_the_text(spark):
    board = "Subscribe to our\tletter 12 today"
    data = [(i, f"{board}\n\nOwn text of document {chr(97 + i)} \n{board.upper()}\n tail {chr(97 + i)} x", "a") for i in range(12)]
    data += [(20, f"{board}\nother host", "b"), (21, board, "a"), (21, board, "a"), (None, f"x\n{board}\n", "a"),
             (22, None, "a"), (23, "", None), (24, "\n\n" + (board + "\n") * 20_000 + "end", "a")]
    got = line_rules.cleaned_documents(spark.createDataFrame(data, SCHEMA).repartition(3)).collect()
    have = sorted((str(r.doc_id), str(r.text), r.removed_lines) for r in got)

    def want(i, t, s):
        gone = [k for k, x in enumerate((t or "").split("\n")) if s == "a" and "SUBSCRIBE" in x.upper()]
        kept = t and "\n".join(x for k, x in enumerate(t.split("\n")) if k not in set(gone))
        return str(i), str(kept), gone
    assert have == sorted(want(*r) for r in data)
    assert any(t == "\nOwn text of document d \n tail d x" for _, t, _ in have)


def plain_mix(data, weights=(5, 2, 1), epochs=3):
    size = [len(WORD.findall(t or "")) for _, t, _ in data]
    total, of = sum(size), Counter()
    for n, (_, _, s) in zip(size, data):
        of[s] += n
    order = sorted(of, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    capped, target = set(), {}
    while True:
        rest = total - sum(epochs * of[s] for s in capped)
        free = [s for s in order if s not in capped]
        target = {s: float(epochs * of[s]) for s in capped} | {
            s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if target[s] > epochs * of[s]}
        if not above:
            return size, of, target
        capped |= above


def test_mix(docs):
    data = rows()
    got = mixing.mix(docs).collect()
    size, of, target = plain_mix(data)
    assert sorted((str(r.doc_id), r.size, r.source_size) for r in got) == sorted(
        (str(i), n, of[s]) for (i, _, s), n in zip(data, size))
    taken, biggest = Counter(), Counter()
    for r in got:
        assert r.target == pytest.approx(target[r.source], rel=1e-12)
        assert r.taken == r.size * r.repeats <= 3 * r.size and r.repeats <= 3
        taken[r.source] += r.taken
        biggest[r.source] = max(biggest[r.source], r.size)
    for s in of:
        assert abs(taken[s] - target[s]) <= biggest[s] / 2 + 1e-6
        whole = int(target[s] // of[s]) if of[s] else 0
        assert {r.repeats for r in got if r.source == s} <= {whole, min(3, whole + 1)}
    # the fractional repetition is a prefix in the order of the keyed hash
    first = {}
    for r in got:
        h = int(hashlib.md5(f"{mixing.SEED}:{'' if r.doc_id is None else r.doc_id}".encode())
                .hexdigest()[:15], 16)
        first.setdefault(r.source, []).append((h, r.doc_id or -1, r.size, -r.repeats))
    for s, keyed in first.items():
        extra = [x[-1] for x in sorted(keyed)]
        assert extra == sorted(extra), s
    again = mixing.mix(docs.repartition(2)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixed_documents(docs):
    """Each row as often as the mix says, repeated rows one by one."""
    plan = Counter()
    for r in mixing.mix(docs).collect():
        plan[(r.doc_id, r.source, r.text_hash)] += r.repeats
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    many = Counter((r.doc_id, r.source, r.h) for r in
                   out.withColumn("h", F.xxhash64("text")).collect())
    assert many == Counter({k: n for k, n in plan.items() if n})


@pytest.mark.parametrize("data", [
    [(1, "a b c", "x"), (2, "", "y"), (3, None, "y"), (4, "d e", "z")],
    [(1, "", "x"), (2, None, "x"), (None, " \n", None)]])
def test_mix_with_sources_without_words(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    got = mixing.mix(df).collect()
    size, of, target = plain_mix(data)
    assert len(got) == len(data)
    for r in got:
        assert r.target == pytest.approx(target[r.source]) and r.taken == r.size * r.repeats
        assert of[r.source] or (r.repeats, r.taken, r.target) == (1, 0, 0)
    assert mixing.mixed_documents(df).count() == sum(r.repeats for r in got)


def test_the_query_of_a_table_without_words(spark, scratch):
    import __spark_entry__ as ent
    spark.createDataFrame([(1, "", "x", None), (2, None, "y", 3)], SCHEMA + ", n_chars long").write.parquet(
        f"{scratch}/documents.parquet")
    assert sorted(map(tuple, ent.queries()["op3_mixing"](spark, scratch).collect())) == [
        (1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


@pytest.mark.parametrize("n", [1, 4, 24])
def test_shards(docs, n):
    got = sharding.shard_documents(docs, n).collect()
    data = sorted(((i is None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 8)
                   for i, t, _ in rows()))
    total, before, want = sum(r[3] for r in data), 0, []
    slots = Counter()
    for none, i, crc, size in data:
        shard = min(n - 1, (2 * before + size) * n // (2 * total))
        want.append((str(None if none else i), size, crc, "bytes", shard, slots[shard], None))
        slots[shard] += 1
        before += size
    key = lambda r: tuple(map(str, r))
    assert sorted(((str(r[0]), *r[1:]) for r in got), key=key) == sorted(want, key=key)


def test_shards_are_near_equal(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"),
                                  F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("text"))
    sizes = [r.s for r in sharding.shard_documents(df, 24).groupBy("shard").agg(
        F.sum("size").alias("s")).collect()]
    assert len(sizes) == 24 and max(sizes) - min(sizes) <= 2 * 58


def test_empty(docs):
    none = docs.limit(0)
    assert line_rules.quality_rules(none).count() == 0
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0
    assert sharding.shard_documents(none).count() == 0
