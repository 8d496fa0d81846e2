"""Merge-dropout: the model's own encoding at rate 0, a plain agenda, round trips."""

import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkwright.llm import merge_dropout as md

MODEL = open(md.MODEL, "rb").read()
M = md.Merges(MODEL)
SP = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
TEXTS = ["", " ", "Hello world", "  two  spaces ", "tab\tnew\nline", "é ß 漢字 𝕏 ①", "▁mark ▁▁ x",
         "a" * 700, "the " * 300, "nospace" * 100 + " end", "<s> </s> <0x0A>", "\x00\x7f　",
         "      many spaces" + " " * 40 + "x", "Thanedble onatth ouha from in in eded"]


def plain(text, key, rate):
    """One merge at a time over the whole text, the best first."""
    if not text:
        return []
    marked = " " + text
    parts = []
    for i, c in enumerate(marked):
        piece = "▁" if c == " " else c
        known = M.char[ord(piece)] if c != "▁" else -1
        parts.append((int(known), i, i + 1))
    limit = md._limit(rate)
    while True:
        best = None
        for k in range(len(parts) - 1):
            (a, s, mid), (b, _, e) = parts[k], parts[k + 1]
            new = M.pairs.get((a, b))
            if new is None or (limit and md._skips(np.array([key], np.uint64), np.array([s]),
                                                   np.array([mid]), np.array([e]), limit)[0]):
                continue
            if best is None or M.rank[new] < best[0]:
                best = (M.rank[new], k, new)
        if best is None:
            break
        _, k, new = best
        parts[k:k + 2] = [(new, parts[k][1], parts[k + 1][2])]
    out = []
    for piece, s, _ in parts:
        out += [piece] if piece >= 0 else [int(M.byte_ids[x]) for x in marked[s].encode()]
    return out


def test_rate_0_is_the_models_encoding():
    texts = [t for t in TEXTS if "▁" not in t]
    for t, ids in zip(texts, md.encode(M, texts, [1] * len(texts), 0.0)):
        assert ids.tolist() == SP.encode(t), t


@pytest.mark.parametrize("rate", [0.1, 0.5, 1.0])
def test_equals_plain_agenda(rate):
    texts = [t[:120] for t in TEXTS]
    for t, ids in zip(texts, md.encode(M, texts, range(len(texts)), rate)):
        assert ids.tolist() == plain(t, texts.index(t), rate), t


def test_heap_and_rounds_agree(monkeypatch):
    a = md.encode(M, TEXTS, range(len(TEXTS)), 0.3)
    monkeypatch.setattr(md, "LONG_CHUNK", 0)
    b = md.encode(M, TEXTS, range(len(TEXTS)), 0.3)
    assert [x.tolist() for x in a] == [x.tolist() for x in b]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=80), st.integers(0, 2 ** 64 - 1), st.sampled_from([0.0, 0.2, 1.0]))
def test_lossless(text, key, rate):
    try:
        text.encode()
    except UnicodeEncodeError:
        return
    assert md.decode(M, md.encode(M, [text], [key], rate)[0].tolist()) == text


def test_documents(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "re"]) for _ in range(4))
    rows = [(i, " ".join(word() for _ in range(50))) for i in range(20)]
    rows += [(1, rows[1][1]), (100, None), (101, ""), (None, rows[0][1]), (102, "x " * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("tokens", F.lit("clash"))
    got = md.encode_documents(df.repartition(4)).collect()
    again = md.encode_documents(df.repartition(2)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
    assert all(r.lossless and r.n_tokens == len(r.tokens) for r in got)
    other = {r.doc_id: r.tokens for r in md.encode_documents(df, seed=2).collect()}
    own = {r.doc_id: r.tokens for r in got}
    assert sum(own[i] != other[i] for i in range(20)) == 20
    # the same text under another id is cut up differently
    assert own[0] != own[None]
    back = sorted(map(str, md.decode_documents(spark.createDataFrame(got)).collect()))
    assert back == sorted(str(r) for r in df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect())
    assert md.encode_documents(df.limit(0)).count() == 0


def test_copies_that_follow_each_other_differ(spark):
    """A mix's copies get segmentations of their own, and all decode."""
    text = " ".join(f"international documentation number {i}" for i in range(30))
    rows = [(1, text)] * 3 + [(2, text), (1, text), (None, text), (None, text), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = md.encode_documents(df).collect()
    assert [r.doc_id for r in got] == [i for i, _ in rows] and all(r.lossless for r in got)
    tokens = [tuple(r.tokens) for r in got]
    assert len({tokens[0], tokens[1], tokens[2], tokens[3]}) == 4
    assert tokens[4] == tokens[0] and tokens[5] != tokens[6]
