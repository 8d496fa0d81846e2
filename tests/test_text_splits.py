"""The inverted index from line splits against whole files."""

import os
import random

import pytest

from sparkwright.plans.text_jobs import inverted_index
from sparkwright.plans.text_splits import inverted_index_splits
from sparkwright.sources.files import read_whole_files


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "64b", "spark.sql.files.openCostInBytes": "1b"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def java_words(text):
    if text == "":
        return [""]
    words = text.split(" ")
    while words and words[-1] == "":
        words.pop()
    return words


def counted(files):
    out = {}
    for name, text in files.items():
        for w in java_words(text):
            out[(w, name)] = out.get((w, name), 0) + 1
    return sorted((*k, n) for k, n in out.items())


def write(root, files):
    os.makedirs(root, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(root, name), "wb") as f:
            f.write(text.encode())


EDGES = ["", " ", "   ", "\n", "\n\n", " \n", "\n ", "a", "a\n", "a \n", "a  ", " a", "a\n  ", "a b\nc d",
         "   \nabc", "a\nb\nc", "x  y \n\n z\n", " \n \n ", "é 😀\r\n b\t c", "\n\na \n\n b\n\n", "a \n "]


def test_every_kind_of_edge(spark, scratch):
    files = {f"f{i:02}": t for i, t in enumerate(EDGES)}
    write(scratch, files)
    got = sorted(map(tuple, inverted_index_splits(spark, scratch).collect()))
    assert got == counted(files)
    whole = inverted_index(read_whole_files(spark, scratch))
    # Spark's whole-file reader passes over the empty file.
    assert [r for r in got if r[1] != "f00"] == sorted(map(tuple, whole.collect()))


def test_one_file_in_many_splits(spark, scratch, small_splits):
    rng = random.Random(6)
    files = {f"r{i}": "".join(rng.choices([" ", "\n", "ab", "c", "é", "   "], [4, 2, 6, 6, 1, 1], k=n))
             for i, n in enumerate((900, 400, 30, 5))}
    files["long"] = "w" * 150 + "\n" + "v" * 300 + "\nend of it"  # a word over many splits
    write(scratch, files)
    df = inverted_index_splits(spark, scratch)
    assert sorted(map(tuple, df.collect())) == counted(files)
    assert spark.read.text(scratch).rdd.getNumPartitions() > 20


def test_compressed_files_are_refused(spark, scratch):
    import gzip
    os.makedirs(scratch, exist_ok=True)
    with gzip.open(os.path.join(scratch, "a.gz"), "wb") as f:
        f.write(b"a b c " * 1000)
    with pytest.raises(Exception, match="not a plain text file"):
        inverted_index_splits(spark, scratch).collect()


def test_no_files(spark, scratch):
    os.makedirs(scratch, exist_ok=True)
    assert inverted_index_splits(spark, scratch).count() == 0


def named_exchanges(df, *stage):
    """The plan's exchanges by the columns ``stage`` into a number of tasks that the query names."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [ln for ln in plan.splitlines() if "hashpartitioning" in ln and "REPARTITION_BY_NUM" in ln
            and all(c in ln for c in stage)]


def test_counts_are_dealt_to_as_many_tasks_as_the_files_are_read_in(spark, scratch, small_splits):
    """What a task counts must not grow with the input, whatever the session's shuffle partitions."""
    rng = random.Random(7)
    files = {f"g{i}": "\n".join(" ".join(rng.choices("abcdefgh", k=9)) for _ in range(60)) for i in range(4)}
    write(scratch, files)
    parts = spark.read.text(scratch).rdd.getNumPartitions()
    df = inverted_index_splits(spark, scratch, sort=False)
    assert parts > 8 == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert any(f", {parts})" in ln for ln in named_exchanges(df, "word", "file"))
    assert any(f", {parts})" in ln for ln in named_exchanges(df, "_h"))
    assert sorted(map(tuple, df.collect())) == counted(files)
    assert [r[:2] for r in map(tuple, inverted_index_splits(spark, scratch).collect())] == [
        r[:2] for r in counted(files)]


def test_whole_files_are_counted_where_they_are_dealt_out(spark, scratch):
    """With ``tasks`` no postings are shuffled to be counted, and the order is the same."""
    files = {f"h{i}": f"b a\nx {i} c  a a" for i in range(30)} | {"z": " \n "}
    write(scratch, files)
    whole = read_whole_files(spark, scratch).unionByName(
        spark.createDataFrame([(None, "a b"), (None, "a"), ("h1", "c c")], "file_name string, content string"))
    plain, dealt = inverted_index(whole), inverted_index(whole, tasks=5)
    assert list(map(tuple, dealt.collect())) == list(map(tuple, plain.collect()))
    assert dealt.rdd.getNumPartitions() <= 5
    unsorted = inverted_index(whole, sort=False, tasks=5)
    exchanges = [ln for ln in unsorted._jdf.queryExecution().executedPlan().toString().splitlines()
                 if "Exchange " in ln]
    assert len(exchanges) == 1 and "hashpartitioning(file" in exchanges[0]
    assert sorted(map(str, unsorted.collect())) == sorted(map(str, plain.collect()))
