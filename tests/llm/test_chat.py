"""Chat formatting: paths against plain recursion, the template against plain parsing."""

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as ent
from conftest import SF0001
from oracle_check import digest
from sparkwright.llm import chat

SCHEMA = ("tree_id STRING, message_id BIGINT, parent_id BIGINT, score DOUBLE, role STRING,"
          " text STRING, node STRING, path STRING")
TURNS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, tree STRING, formatted STRING"


def messages(spark, rows):
    return chat.reply_messages(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA))


def plain_paths(rows, branches):
    """{tree: [texts of a path, ...]} best first, by recursion from each leaf."""
    out = {}
    for tree in {r[0] for r in rows}:
        here = sorted({r for r in rows if r[0] == tree}, key=lambda r: r[1])
        by_id = {r[1]: r for r in here}
        replied = {r[2] for r in here}
        found = []
        for leaf in (r for r in here if r[1] not in replied):
            path, seen = [leaf], {leaf[1]}
            while path[-1][2] in by_id and path[-1][2] not in seen:
                path.append(by_id[path[-1][2]])
                seen.add(path[-1][1])
            if path[-1][2] in by_id:  # a cycle
                continue
            found.append((-sum(r[3] or 0 for r in path), leaf[1], [r[5] for r in path[::-1]]))
        found.sort(key=lambda x: x[:2])
        if found:
            out[tree] = [p for _, _, p in found[:branches]]
    return out


def listed(done):
    out = {}
    for r in sorted(done.select("tree", "rank", "total", chat.turns_of(F.col("formatted")).alias("turns"),
                                "path").collect(), key=lambda r: (r.rank, -r.total, r.path)):
        out.setdefault(r.tree, []).append([t.text for t in r.turns])
    return out


@pytest.mark.parametrize("branches", [1, 3, None])
def test_paths_of_random_trees(spark, branches):
    rng = random.Random(branches or 9)
    rows = []
    for tree in ("a", "b", "c", None):
        for i in range(40):
            parent = rng.randrange(i) if i > 2 and rng.random() < 0.95 else None
            rows.append((tree, i, parent, float(rng.randrange(-3, 4)), rng.choice(["user", "assistant"]),
                         f"{tree}{i}"))
    rows += [("d", i, i - 1 if i else None, None, "user", f"d{i}") for i in range(33)]  # a deep chain
    rows += [("e", 1, 2, 1.0, "user", "e1"), ("e", 2, 1, 1.0, "user", "e2"),           # a cycle
             ("e", 3, 2, 1.0, "user", "e3"), ("e", 4, 77, 1.0, "user", "e4")]          # no such parent
    m = messages(spark, rows).cache()
    got = listed(chat.format_paths(m, chat.chosen_paths(m, branches)))
    assert got == plain_paths(rows, branches)


def test_repeated_rows_and_null_ids(spark):
    rows = [("t", 1, None, 0.0, "user", "q"), ("t", 1, None, 0.0, "user", "q"),
            ("t", 2, 1, float("nan"), "assistant", "a"), ("t", None, 1, 5.0, None, None)]
    m = messages(spark, rows).cache()
    done = chat.format_paths(m, chat.chosen_paths(m, None))
    assert sorted(map(tuple, listed(done)["t"])) == [("q",), ("q", ""), ("q", "a")]
    assert chat.format_paths(m, chat.chosen_paths(m, 1)).select(
        chat.turns_of(F.col("formatted"))["text"].alias("x")).collect()[0].x == ["q", ""]


def plain_read(formatted):
    """Turns by a scan over the characters."""
    turns = []
    for piece in formatted.split("<|im_end|>\n")[:-1]:
        assert piece.startswith("<|im_start|>")
        parts = piece[len("<|im_start|>"):].split("<|im_sep|>")
        assert len(parts) == 2
        read = []
        for p in parts:
            out, i = "", 0
            while i < len(p):
                i += p[i] == "\\"
                out += p[i]
                i += 1
            read.append(out)
        turns.append(tuple(read))
    return turns


def test_template_round_trip(spark):
    rng = random.Random(3)
    bits = [*chat.CONTROL, "\\", "\\\\", "<", "|", "[", "im_end|>", "\n", "é", "😀", " ", "", "user",
            "<|im_sep|", "<<SYS>", "<|im_end|>\n"]
    convs = {c: [("".join(rng.choices(bits, k=rng.randrange(3))) or rng.choice(["user", "assistant"]),
                  "".join(rng.choices(bits, k=rng.randrange(12)))) for _ in range(rng.randrange(1, 6))]
             for c in range(60)}
    convs[60] = [("assistant", "x" * 300_000 + "</s>")]
    rows = [(c, i, r, t, "z", "z") for c, v in convs.items() for i, (r, t) in enumerate(v)]
    rng.shuffle(rows)
    done = chat.format_conversations(spark.createDataFrame(rows, TURNS).repartition(5))
    got = {r.conv_id: r for r in done.collect()}
    assert got.keys() == convs.keys()
    for c, turns in convs.items():
        assert plain_read(got[c].formatted) == turns
        assert len(got[c].loss_spans) == sum(r == "assistant" for r, _ in turns)
        for turn in got[c].formatted.split("<|im_end|>\n")[:-1]:
            body = turn.removeprefix("<|im_start|>").replace("<|im_sep|>", "", 1)
            assert not any(x in body for x in chat.CONTROL)
    for r in chat.digests(done).collect():
        turns = convs[r.conv_id]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == len(got[r.conv_id].formatted)


def test_nulls_ties_and_empty(spark):
    rows = [(None, None, None, None), (None, 1, "user", "a"), (5, 2, "user", "b"), (5, 2, "user", "b"),
            (5, 1, "assistant", None), (5, None, "assistant", "z")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS)
    got = {r.conv_id: plain_read(r.formatted) for r in chat.format_conversations(df).collect()}
    assert got == {None: [("user", "a"), ("", "")],
                   5: [("assistant", ""), ("user", "b"), ("user", "b"), ("assistant", "z")]}
    assert chat.digests(chat.format_conversations(df.limit(0))).count() == 0
    empty = messages(spark, [])
    assert chat.format_paths(empty, chat.chosen_paths(empty)).count() == 0


def test_query_matches_sql(spark):
    df = ent.queries()["op13_chat_format"](spark, SF0001)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF0001}/conversations.parquet'")
    res = con.execute(ent.oracle_sql()["op13_chat_format"])
    cols, rows = [d[0] for d in res.description], res.fetchall()
    got = [tuple(r) for r in df.collect()]
    assert digest(got, df.columns)[0] == digest(rows, cols)[0]
    assert any(r[0] == -7 for r in got)
