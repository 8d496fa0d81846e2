"""The pipeline's stages against plain versions, each on its own input."""

from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline as cp
from sparkwright.llm import merge_dropout, mixing, toxicity
from sparkwright.sources.files import table
from test_merge_dropout import M
from test_rules_mix_shards import rows as edge_rows
from test_simhash import plain_components, plain_fingerprint
from test_substring import plain as plain_cut

DATA = "/root/testdata/sf0.001"
KEEP = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark):
    """A real table with edge cases added: nulls, empty, long and repeated texts."""
    extra = spark.createDataFrame(
        [(None if i is None else i + 5000, t, "xx", s, len(t or "")) for i, t, s in edge_rows()],
        "doc_id long, text string, lang string, source string, n_chars long")
    return table(spark, DATA, "documents").select(KEEP).unionByName(extra).cache()


def listed(df):
    return [tuple(r) for r in df.select("doc_id", "text", "source").collect()]


def test_stages(spark, docs):
    names = [n for n, _ in cp.STAGES]
    assert names == ["toxicity", "simhash_dedup", "substring_dedup", "mixing", "merge_dropout"]
    stage = dict(cp.STAGES)

    clean = stage["toxicity"](spark, docs, DATA)
    assert clean.columns == KEEP
    scored = toxicity.toxicity_scores(docs, table(spark, DATA, "labels")).collect()
    bad = {(r.doc_id, r.text_hash) for r in scored if r.predicted}
    before = docs.withColumn("h", F.xxhash64("text")).collect()
    assert Counter(listed(clean)) == Counter(
        (r.doc_id, r.text, r.source) for r in before if (r.doc_id, r.h) not in bad)
    clean = clean.cache()

    one = stage["simhash_dedup"](spark, clean, DATA)
    assert one.columns == KEEP
    given = listed(clean)
    fps = [plain_fingerprint(t) for _, t, _ in given]
    best = {}
    for g, (i, t, s) in zip(plain_components(fps, 4), given):
        h = 42 if t is None else xxhash.xxh64_intdigest(t.encode(), 42)
        rank = (i is None, i or 0, h - (1 << 64) if h >> 63 else h)
        best[g] = min(best.get(g, (rank, i, t)), (rank, i, t), key=lambda x: x[0])
    assert Counter((i, t) for i, t, _ in listed(one)) == Counter((i, t) for _, i, t in best.values())
    one = one.cache()

    cut = stage["substring_dedup"](spark, one, DATA).cache()
    assert cut.columns == KEEP
    given = [(i, t) for i, t, _ in listed(one)]
    want = [(i, t) for i, t, spans in plain_cut(given, 8)
            if spans == "[]" or t.strip(" \t\n\x0b\x0c\r")]
    assert sorted((str(i), str(t)) for i, t, _ in listed(cut)) == sorted(want)
    changed = {t for _, t in given}
    assert all(r.n_chars == len(r.text) for r in cut.collect()
               if r.text is not None and r.text not in changed)

    mixed = stage["mixing"](spark, cut, DATA).cache()
    assert mixed.columns == KEEP
    plan = Counter()
    for r in mixing.mix(cut).collect():
        plan[(r.doc_id, r.source, r.text_hash)] += r.repeats
    got = Counter((r.doc_id, r.source, r.h) for r in mixed.withColumn("h", F.xxhash64("text")).collect())
    assert got == Counter({k: n for k, n in plan.items() if n})

    encoded = stage["merge_dropout"](spark, mixed, DATA).collect()
    assert Counter((r.doc_id, merge_dropout.decode(M, r.tokens)) for r in encoded) == Counter(
        (i, t or "") for i, t, _ in listed(mixed))
    assert all(r.lossless for r in encoded)


def test_run_is_the_stages_in_order(spark):
    got = cp.run(spark, DATA).collect()
    df = table(spark, DATA, "documents")
    for _, f in cp.STAGES:
        df = f(spark, df, DATA).cache()
    assert sorted(map(str, got)) == sorted(map(str, df.collect())) and got


def test_stages_on_no_documents(spark):
    none = table(spark, DATA, "documents").limit(0)
    for _, f in cp.STAGES:
        none = f(spark, none, DATA).cache()
        assert none.count() == 0
