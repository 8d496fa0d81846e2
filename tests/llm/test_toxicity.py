"""Weak supervision: held-out accuracy, correlations, edge cases."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkwright.llm import toxicity as tx

DATA = "/root/testdata/sf0.1"


def corpus(n=700, seed=2):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["an", "er", "thi", "on", "re", "qu"])
                           for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(8, 120))]
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(rng.randint(2, 4)):
                words.insert(rng.randrange(len(words)), "zorbl" + word())
        rows.append((i, " ".join(words)))
        if rng.random() < 0.7:
            labels.append((i, int(toxic != (rng.random() < 0.02))))
    return rows, labels


def test_learns_the_labels_and_handles_edge_cases(spark):
    rows, labels = corpus()
    extra = [(9001, None), (9002, ""), (9003, " \n"), (None, "no id"), (9004, rows[0][1]),
             (9004, rows[0][1]), (9005, "an er " * 50_000), (9006, "you stupid idiot, pathetic scum")]
    df = spark.createDataFrame(rows + extra, "doc_id long, text string").withColumns(
        {"votes": F.lit("clash"), "score": F.lit(1)})
    lab = spark.createDataFrame(labels + [(5, None), (9999, 1), (None, 1)], "doc_id long, toxic int")
    got = tx.toxicity_scores(df, lab).collect()
    assert len(got) == len(rows) + len(extra)
    text = dict(rows + extra)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    wrong = [r.doc_id for r in got if r.doc_id is not None and r.doc_id < 9000
             and r.predicted != int("zorbl" in text[r.doc_id])]
    assert len(wrong) <= 0.02 * len(rows)
    again = tx.toxicity_scores(df.repartition(3), lab).collect()
    assert {(r.doc_id, round(r.score, 9)) for r in got} == {(r.doc_id, round(r.score, 9)) for r in again}
    kept = tx.drop_toxic(df, lab)
    assert kept.columns == df.columns
    assert kept.count() == sum(r.predicted == 0 for r in got)


def test_labels_of_held_out_rows_change_nothing(spark):
    rows, labels = corpus(300)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    other = [(i, 1 - y if held(i) else y) for i, y in labels]
    a, b = (sorted(tuple(r) for r in tx.toxicity_scores(
        df, spark.createDataFrame(x, "doc_id long, toxic int")).collect()) for x in (labels, other))
    assert a == b


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    got = tx.toxicity_scores(docs, labels).filter("held_out").join(labels, "doc_id").collect()
    y, s = np.array([r.toxic for r in got]), np.array([r.score for r in got])
    auc = ((s[y == 1][:, None] > s[y == 0]) + 0.5 * (s[y == 1][:, None] == s[y == 0])).mean()
    assert auc > 0.95 and (s[y == 0] >= 0.5).mean() < 0.01 and (s[y == 1] >= 0.5).mean() > 0.85


def test_without_labels_or_documents(spark):
    rows, _ = corpus(50)
    df = spark.createDataFrame(rows + [(99, "stupid idiot")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert tx.toxicity_scores(df, none).count() == 51
    assert tx.toxicity_scores(df.limit(0), none).count() == 0


def test_label_model_finds_rates_and_correlated_voters():
    rng = np.random.default_rng(0)
    n, voters = 200_000, tx.VOTERS
    y = rng.random(n) < 0.1
    rate = np.where(np.arange(voters) < 7, 0.6, 0.1)
    votes = rng.random((n, voters)) < np.where(y[:, None], rate, 0.03 + 0.05 * (np.arange(voters) > 6))
    votes[:, 2] = np.where(rng.random(n) < 0.9, votes[:, 1], votes[:, 2])
    code = (votes * (1 << np.arange(voters))).sum(1)
    gold = np.where(rng.random(n) < 0.02, y, -1)
    keys, counts = np.unique(code * 4 + gold + 1, return_counts=True)
    m = tx.LabelModel(keys // 4, keys % 4 - 1, counts.astype(float))
    assert m.prior == pytest.approx(0.1, abs=0.02)
    assert m.rates[1][:2] == pytest.approx([0.6, 0.6], abs=0.08)
    assert [1, 2] in m.blocks and m.correlations[1, 2] > 0.5
    post = m.posterior(code, np.full(n, -1))
    assert ((post >= 0.5) == y).mean() > 0.98


def plain_em(rows, gold, prior, rounds):
    """Expectation maximisation row by row, every voter by itself."""
    voters, lexical = tx.VOTERS, 1 + tx.LEXICONS
    def odds(p):
        return np.log(p / (1 - p))
    post = []
    for r, g in zip(rows, gold):
        z = odds(prior) + sum(np.log(10) if r >> k & 1 else np.log(0.9) for k in range(lexical))
        post.append(1 / (1 + np.exp(-z)) if g < 0 else (0.95 if g == 1 else 0.05))
    n = len(rows)
    for _ in range(rounds):
        table = {}
        for y in (0, 1):
            mass = sum(p if y else 1 - p for p in post) / n
            for k in range(voters):
                for v in (0, 1):
                    t = sum((p if y else 1 - p) for r, p in zip(rows, post) if (r >> k & 1) == v) / n
                    table[y, k, v] = t + 1e-4 * mass / 2 + 1e-9
                total = table[y, k, 0] + table[y, k, 1]
                table[y, k, 0], table[y, k, 1] = table[y, k, 0] / total, table[y, k, 1] / total
            own = [max(sum((p if y else 1 - p) for g, p in zip(gold, post) if g == v) / n, 1e-9)
                   for v in (0, 1)]
            table[y, "gold"] = [x / sum(own) for x in own]
        prior = min(max(sum(post) / n, 1e-4), 0.6)
        post = []
        for r, g in zip(rows, gold):
            z = odds(prior) + sum(np.log(table[1, k, r >> k & 1] / table[0, k, r >> k & 1])
                                  for k in range(voters))
            if g >= 0:
                z += np.log(table[1, "gold"][g] / table[0, "gold"][g])
            post.append(1 / (1 + np.exp(-min(max(z, -30), 30))))
    return np.array(post), prior


def test_label_model_equals_plain_em():
    """Counts of patterns or row by row: the same posteriors."""
    rng = np.random.default_rng(7)
    n = 300
    y = rng.random(n) < 0.2
    votes = rng.random((n, tx.VOTERS)) < np.where(y[:, None], 0.5, 0.06)
    rows = (votes * (1 << np.arange(tx.VOTERS))).sum(1)
    gold = np.where(rng.random(n) < 0.3, y.astype(int), -1)
    keys, counts = np.unique(rows * 4 + gold + 1, return_counts=True)
    m = tx.LabelModel(keys // 4, keys % 4 - 1, counts.astype(float), joined_above=2.0, rounds=25)
    assert m.blocks == [[k] for k in range(tx.VOTERS)]
    known = gold >= 0
    start = float(np.clip((gold == 1).sum() / known.sum(), 0.001, 0.5))
    want, prior = plain_em(rows.tolist(), gold.tolist(), start, 25)
    assert m.posterior(rows, gold) == pytest.approx(want, abs=1e-6)
    assert m.prior == pytest.approx(prior, abs=1e-6)  # the model stops at changes below 1e-7


def test_linear_classifier_equals_a_dense_solver():
    """The weights of Newton's method on the same ridge problem."""
    rng = np.random.default_rng(3)
    n, k = 400, 12
    x = (rng.random((n, k)) < 0.25).astype(float)
    target = np.clip(1 / (1 + np.exp(-(x @ rng.normal(size=k) - 0.5))) + 0.05 * rng.normal(size=n), 0, 1)
    row, column = np.nonzero(x)
    got = tx.train_linear(row, column, k, target, ridge=0.01, rounds=4000)
    dense, w = np.c_[x, np.ones(n)], np.zeros(k + 1)
    ridge = np.r_[np.full(k, 0.01), 0]
    for _ in range(50):
        p = 1 / (1 + np.exp(-dense @ w))
        slope = dense.T @ (p - target) / n + ridge * w
        curve = (dense * (p * (1 - p))[:, None]).T @ dense / n + np.diag(ridge)
        w = w - np.linalg.solve(curve, slope)
    assert got == pytest.approx(w, abs=1e-4)


def test_calibration():
    """Shifted and scaled logits are put right; separable, one-class and
    contradicting labels give finite values."""
    rng = np.random.default_rng(4)
    z = rng.normal(size=20_000) * 2
    y = (rng.random(len(z)) < 1 / (1 + np.exp(-(1.5 * z - 0.7)))).astype(int)
    assert tx.calibrate(z, y) == pytest.approx([1.5, -0.7], abs=0.1)
    slope, offset = tx.calibrate(np.array([-2.0, -1, 1, 2]) + 5, np.array([0, 0, 1, 1]))
    assert 0 < slope < 100 and slope * 4 + offset < 0 < slope * 6 + offset
    for logits, labels in (([1.0, 2], [1, 1]), ([], []), ([-1.0, 1], [1, 0])):
        assert tx.calibrate(np.array(logits), np.array(labels, int)).tolist() == [1, 0]
