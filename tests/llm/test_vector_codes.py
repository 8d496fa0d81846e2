"""Vector codes against a plain k-means over all points in Python integers."""

import hashlib
import math

import duckdb
import numpy as np
import pytest

import __spark_entry__ as ent
from conftest import SF0001
from oracle_check import digest
from sparkwright.llm import vector_codes as vc

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, q STRING, ids STRING, code STRING"


def plain(rows, n_parts=8, k=16, rounds=6):
    kept = []
    for i, v, label in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(4096 * float(np.float32(x))) for x in v], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], ""
    w = len(kept[0][1]) // n_parts
    cut = [[r[1][p * w:(p + 1) * w] for p in range(n_parts)] for r in kept]
    books = [[list(c[p]) for c in cut[:k]] for p in range(n_parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            mine = [[] for _ in book]
            for c in cut:
                mine[nearest(c[p], book)[1]].append(c[p])
            books[p] = [[sum(z) // len(m) for z in zip(*m)] if m else e for m, e in zip(mine, book)]
    out, by_label = [], {}
    for (i, _, label), c in zip(kept, cut):
        found = [nearest(c[p], books[p]) for p in range(n_parts)]
        error = sum(d for d, _ in found)
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, label, "".join(f"{e:02x}" for _, e in found), error))
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((str(i), c, e, by_label[label]) for i, label, c, e in out), sha


def ran(spark, rows, parts=4, **params):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(parts)
    got = vc.compressed(df, **params).collect()
    assert len({r.codebooks_sha256 for r in got}) <= 1
    return (sorted((str(r.vec_id), r.code, r.error, r.label_error) for r in got),
            got[0].codebooks_sha256 if got else "")


def clustered(n, dim, seed, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    v = centres[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, dim))
    return [(i, [float(np.float32(x)) for x in r], i % 5 if i % 7 else None) for i, r in enumerate(v)]


@pytest.mark.parametrize("dim, spread", [(64, 0.05), (64, 1.0), (8, 0.02), (24, 0.3)])
def test_equals_plain_kmeans(spark, dim, spread):
    rows = clustered(600, dim, dim, spread)
    assert ran(spark, rows) == plain(rows)


def test_small_blocks_give_the_same(spark, monkeypatch):
    rows = clustered(500, 16, 3)
    monkeypatch.setattr(vc, "BLOCK_VALUES", 1)
    assert ran(spark, rows, parts=3) == plain(rows)


def test_ties_repeated_rows_nulls(spark):
    grid = [(i, [float((i * 7 + j) % 3 - 1) / 4 for j in range(16)], None) for i in range(120)]
    hot = [(7, [0.25] * 16, 1)] * 300 + [(None, [0.25] * 16, 1), (None, [-0.1] * 16, None)]
    bad = [(900, None, 1), (901, [float("nan")] * 16, 1), (902, [float("inf")] * 16, 1),
           (903, [None] + [0.0] * 15, 2), (-5, [-1.0] * 15 + [float("-inf")], 2)]
    rows = grid + hot + bad
    assert ran(spark, rows) == plain(rows)


def test_few_and_no_vectors(spark):
    rows = clustered(5, 64, 8)
    assert ran(spark, rows) == plain(rows)
    assert ran(spark, []) == ([], "")
    assert ran(spark, [(1, None, 1)]) == ([], "")


def test_other_parameters(spark):
    rows = clustered(300, 12, 5, 0.5)
    assert ran(spark, rows, n_parts=3, n_entries=40, rounds=2) == plain(rows, 3, 40, 2)


@pytest.mark.parametrize("rows", [[(1, [1e30] * 8, 1)], [(1, [0.0] * 8, 1), (2, [0.0] * 16, 1)],
                                  [(1, [0.0] * 7, 1)]])
def test_unusable_vectors_fail(spark, rows):
    with pytest.raises(Exception, match="2\\^29|components"):
        ran(spark, rows)


def test_tree_caches_and_prunes():
    rng = np.random.default_rng(1)
    centres = rng.integers(-20_000, 20_000, (16, 8))
    points = centres[rng.integers(0, 16, 3000)] + rng.integers(-300, 300, (3000, 8))
    t = vc._unpacked(vc.build_tree(points))
    assert sorted(t["place"]) == list(range(3000))
    assert (points[t["place"]] == t["points"]).all()
    for b in range(len(t["first"])):
        x = t["points"][t["first"][b]:t["stop"][b]]
        assert (x.sum(0) == t["sums"][b]).all()
        assert np.sqrt(((x - x.mean(0)) ** 2).sum(1)).max() <= t["radius"][b]
        if t["left"][b] >= 0:
            a, c = t["left"][b], t["right"][b]
            assert (t["first"][a], t["stop"][a], t["stop"][c]) == (
                t["first"][b], t["first"][c], t["stop"][b])
    balls, by, loose, loose_by = vc.owners(t, centres)
    d = ((t["points"][:, None] - centres) ** 2).sum(2)
    want, got = d.argmin(1), np.full(3000, -1)
    for b, e in zip(balls, by):
        got[t["first"][b]:t["stop"][b]] = e
    got[loose] = loose_by
    assert (got == want).all()
    # Clustered points: nearly all are assigned by whole balls, few balls are looked at.
    assert len(loose) < 300 and len(balls) < 300


def test_query_matches_sql(spark):
    df = ent.queries()["op12_vector_codes"](spark, SF0001)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF0001}/embeddings.parquet'")
    res = con.execute(ent.oracle_sql()["op12_vector_codes"])
    cols, rows = [d[0] for d in res.description], res.fetchall()
    assert digest([tuple(r) for r in df.collect()], df.columns)[0] == digest(rows, cols)[0]
