"""Sources and sinks: whole files, delimited rows, keyed text output,
catalog lifecycle, parallel copy."""

import os

import pytest
from pyspark.sql import functions as F

from sparkwright.operators import cells
from sparkwright.plans.filecopy import distcp
from sparkwright.plans.text_jobs import inverted_index, word_count, word_count_text_lines
from sparkwright.sinks.files import write_keyed_text, write_text
from sparkwright.sources.files import delimited_to_rows, read_lines, read_whole_files


def _write_files(root, files):
    for name, text in files.items():
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(text)


def test_whole_files_inverted_index(spark, scratch):
    _write_files(scratch, {"a.txt": "x y\nx", "sub/b.txt": "y y"})
    files = spark.read.option("recursiveFileLookup", "true").text(scratch, wholetext=True) \
        .select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("content"))
    got = sorted(tuple(r) for r in inverted_index(files).collect())
    # whole-file split on single spaces: "y\nx" stays one word
    assert got == [("x", "a.txt", 1), ("y", "b.txt", 2), ("y\nx", "a.txt", 1)]
    assert read_whole_files(spark, os.path.join(scratch, "a.txt")).first().file_name == "a.txt"


def test_delimited_rows_short_lines(spark, scratch):
    write_text(spark.createDataFrame([("1,a,b,c, d ",), ("2,a",)], "value string"), scratch)
    lines = read_lines(spark, scratch)
    rows = sorted(tuple(r) for r in delimited_to_rows(
        lines, "id f1 f2 f3 f4", on_short="null").collect())
    assert rows == [("1", "a", "b", "c", "d"), ("2", "a", None, None, None)]
    with pytest.raises(Exception):
        delimited_to_rows(lines, "id f1 f2 f3 f4").collect()


def test_word_count_outputs_agree(spark, scratch):
    lines = spark.createDataFrame([("a b a",), ("b  c",), ("",)], "value string")
    wc = word_count(lines)
    assert [tuple(r) for r in wc.collect()] == [("a", 2), ("b", 2), ("", 2), ("c", 1)] or \
        [tuple(r) for r in wc.collect()] == [("", 2), ("a", 2), ("b", 2), ("c", 1)]
    assert word_count_text_lines(wc).first().value.startswith("(")
    counts = lines.select(F.explode(F.split("value", " ")).alias("word")).groupBy("word").count()
    write_keyed_text(word_count(lines).withColumnRenamed("cnt", "n"), scratch, "word", ["n"], 2)
    files = [f for f in os.listdir(scratch) if f.startswith("part-")]
    assert len(files) == 2
    back = {tuple(r.value.split("\t")) for r in read_lines(spark, scratch).collect()}
    assert back == {(r.word, str(r.cnt)) for r in wc.collect()}
    assert counts.count() >= 3


def test_table_lifecycle(spark, scratch):
    name = "sw_cells_test"
    cells.drop_table(spark, name)
    assert not cells.table_exists(spark, name)
    seed = spark.createDataFrame([("r1", "info", "q", 1, "v")], cells.CELL_SCHEMA)
    assert cells.create_table_if_absent(spark, name, scratch, seed)
    assert not cells.create_table_if_absent(spark, name, scratch, seed)
    assert name in cells.list_tables(spark)
    assert spark.table(name).count() == 1
    cells.drop_table(spark, name)
    assert not cells.table_exists(spark, name)


def _tree(root):
    out = {}
    for d, folders, files in os.walk(root):
        rel = os.path.relpath(d, root)
        out.update({os.path.normpath(f"{rel}/{x}"): None for x in folders})
        for x in files:
            with open(os.path.join(d, x)) as f:
                out[os.path.normpath(f"{rel}/{x}")] = f.read()
    return out


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_distcp(spark, scratch, scheme):
    src, dst = os.path.join(scratch, "src"), os.path.join(scratch, "dst2")
    _write_files(src, {f"d{i}/f{j}.txt": f"file {i} {j}" * (j + 1) for i in range(3) for j in range(4)}
                 | {".hid": "h", "_SUCCESS": "", "a.txt": "a", "sub/100%.txt": "p",
                    "sub/_meta.json": "{}", "sub/b c.txt": "b", "sub/deep/x": "x"})
    os.makedirs(os.path.join(src, "empty/inner"))
    manifest = distcp(spark, scheme + src, scheme + dst + "/", os.path.join(scratch, "m1"), m=3)
    rows = manifest.collect()
    assert _tree(dst) == _tree(src)
    assert sorted(r.status for r in rows) == ["copied"] * 19 + ["folder"] * 7
    assert sum(r.bytes for r in rows) == sum(len(t) for t in _tree(src).values() if t)
    with pytest.raises(FileExistsError):
        distcp(spark, src, dst, os.path.join(scratch, "m2"))
    # -i: non-empty target allowed, copy errors recorded instead of failing
    again = distcp(spark, src, dst, os.path.join(scratch, "m3"), ignore_failures=True).collect()
    assert {r.status for r in again} == {"copied", "folder"}


def test_distcp_of_one_file_and_of_an_empty_tree(spark, scratch):
    _write_files(scratch, {"one file.txt": "text"})
    os.makedirs(os.path.join(scratch, "none"))
    one, none = os.path.join(scratch, "to1"), os.path.join(scratch, "to2")
    (row,) = distcp(spark, os.path.join(scratch, "one file.txt"), one,
                    os.path.join(scratch, "m1")).collect()
    assert row.status == "copied" and _tree(one) == {"one file.txt": "text"}
    assert distcp(spark, os.path.join(scratch, "none"), none,
                  os.path.join(scratch, "m2")).count() == 0
    assert os.path.isdir(none)
    with pytest.raises(FileNotFoundError):
        distcp(spark, os.path.join(scratch, "absent"), none, os.path.join(scratch, "m3"))


def test_distcp_by_ranges_survives_a_killed_task(spark, scratch, monkeypatch):
    """One file in many ranges; a worker dies in the middle of a range on its
    first try, and a commit is run twice."""
    import random

    from sparkwright.plans import filecopy
    src, dst = os.path.join(scratch, "src"), os.path.join(scratch, "dst")
    os.makedirs(src)
    data = random.Random(1).randbytes(1_000_003)
    for name, part in (("big", data), ("exact", data[:200_000]), ("none", b""), ("one", b"x")):
        with open(os.path.join(src, name), "wb") as f:
            f.write(part)
    copy, commit = filecopy._copy_range, filecopy._commit
    once = os.path.join(scratch, "died")

    def dies_once(src, tmp, start, size, positional):
        if start == 300_000 and not os.path.exists(once):
            copy(src, tmp, start, size // 2, positional)
            with open(once, "w"):
                pass
            raise OSError("killed")
        return copy(src, tmp, start, size, positional)
    monkeypatch.setattr(filecopy, "_copy_range", dies_once)
    ran = filecopy._copier(True)
    frames = []
    ranges = filecopy.byte_ranges(spark.createDataFrame(
        [(f"file://{src}/{n}", f"file://{dst}/{n}", os.path.getsize(f"{src}/{n}"), False)
         for n in os.listdir(src)], "src string, dst string, length long, is_dir boolean"),
        100_000, True, "id").toPandas()
    assert sorted(ranges.groupby("dst").size()) == [1, 1, 2, 11]
    frames = list(ran([ranges]))[0]
    assert frames["error"].notna().sum() == 1  # that try failed; Spark runs the task again
    assert not os.path.exists(f"{dst}/big")    # nothing under its name before the commit
    again = list(ran([ranges]))[0]
    assert again["error"].isna().all()
    done = again.groupby(["src", "dst", "tmp", "is_dir", "length"], as_index=False).agg(
        bytes=("bytes", "sum"), error=("error", "first"))
    first, second = (list(commit([done]))[0] for _ in range(2))
    assert first.equals(second) and set(first["status"]) == {"copied"}
    for name in os.listdir(src):
        with open(f"{src}/{name}", "rb") as a, open(f"{dst}/{name}", "rb") as b:
            assert a.read() == b.read()
    assert sorted(os.listdir(dst)) == sorted(os.listdir(src))

    whole = os.path.join(scratch, "whole")
    monkeypatch.setattr(filecopy, "_copy_range", copy)
    rows = distcp(spark, src, whole, os.path.join(scratch, "m"), range_bytes=70_000).collect()
    assert sorted(r.bytes for r in rows) == [0, 1, 200_000, 1_000_003]
    assert {n: open(f"{whole}/{n}", "rb").read() for n in os.listdir(whole)} == \
        {n: open(f"{src}/{n}", "rb").read() for n in os.listdir(src)}


def test_listing_by_levels(spark, scratch, monkeypatch):
    """A flat root, a chain deeper than a task's budget and times; the driver
    lists nothing."""
    import datetime as dt

    import pyarrow.fs as pafs

    from sparkwright.sources.listing import list_files, list_tree
    want = {f"f{i}": i for i in range(300)}
    chain = "/".join(f"c{i}" for i in range(25))
    want |= {f"{chain}/end": 7, "c0/c1/.hidden": 3}
    _write_files(scratch, {k: "x" * n for k, n in want.items()})
    os.makedirs(os.path.join(scratch, "empty"))
    stamp = dt.datetime(2020, 5, 17, 12, 30, 15, 250_000, tzinfo=dt.timezone.utc).timestamp()
    os.utime(os.path.join(scratch, "f7"), (stamp, stamp))

    def refuse(*a, **k):
        raise AssertionError("listed on the driver")
    monkeypatch.setattr(pafs, "FileSelector", refuse)
    tree = list_tree(spark, scratch, tasks=3, budget=4).collect()
    base = f"file://{scratch}/"
    assert {r.path.removeprefix(base): r.length for r in tree if not r.is_dir} == want
    assert len(tree) == len({r.path for r in tree})
    assert {r.path.removeprefix(base) for r in tree if r.is_dir} == {"empty"} | {
        "/".join(chain.split("/")[:i + 1]) for i in range(25)}
    (f7,) = [r for r in list_files(spark, scratch).filter("path like '%/f7'").collect()]
    assert f7.length == 7 and f7.modification_time.astimezone(dt.timezone.utc).timestamp() == stamp
    (own,) = list_tree(spark, os.path.join(scratch, "f9")).collect()
    assert own.length == 9 and own.path == base + "f9" and not own.is_dir


def test_copy_plan_refuses_files_outside_the_root(spark):
    from sparkwright.plans.filecopy import plan_copy
    files = spark.createDataFrame([("file:///a/bc/x", 1, False)], "path string, length long, is_dir boolean")
    assert plan_copy(files, "file:///a/bc", "s3a://t/u").first().dst == "s3a://t/u/x"
    with pytest.raises(Exception, match="not below"):
        plan_copy(files, "file:///a/b", "file:///t").collect()


def test_carriage_returns_tabs_and_null_fields_survive(spark, scratch):
    rows = [("a\rb",), ("c\td",), ("",)]
    write_text(spark.createDataFrame(rows, "value string"), f"{scratch}/text")
    assert sorted(r.value for r in read_lines(spark, f"{scratch}/text").collect()) == ["", "a\rb", "c\td"]
    keyed = spark.createDataFrame([("k", None, 2, 3)], "k string, a long, b long, c long")
    write_keyed_text(keyed, f"{scratch}/keyed", "k", ["a", "b", "c"], 1)
    assert read_lines(spark, f"{scratch}/keyed").first().value == "k\t\t2\t3"


def test_bad_input_fails_unless_lenient(spark):
    from sparkwright.functions.udfs import json_items
    from sparkwright.sources.topics import parse_transactions, render_topic
    bad = spark.createDataFrame([("[1, 2",), ('["x"]',), (None,)], "j string")
    with pytest.raises(Exception, match="not a JSON array"):
        json_items(bad, "j").collect()
    assert [r.items for r in json_items(bad, "j", lenient=True).collect()] == ["x"]
    topic = spark.createDataFrame([(1, "k", "7,5,2024-01-01 00:00:00.000000"), (2, "k", "x,y,z"),
                                   (3, "k", None)], "offset long, key string, value string")
    with pytest.raises(Exception, match="malformed record"):
        parse_transactions(topic, watermark=None).collect()
    assert [r.amount for r in parse_transactions(topic, None, lenient=True).collect()] == [5]
    tx = spark.createDataFrame([(7, None, None)], "account_id long, amount long, transaction_time timestamp")
    records = render_topic(tx, "account_id", tx.columns)
    assert records.first().value == "7,,"
    assert tuple(parse_transactions(records, None).first()) == (7, None, None)


def test_jdbc_reader_asks_for_bounds(spark):
    from sparkwright.sources.jdbc import read_table
    with pytest.raises(ValueError, match="one_task"):
        read_table(spark, "jdbc:none", "t", {})


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from sparkwright.session import ensure_checkpoint_dir
    conf = SimpleNamespace(get=lambda key, default=None: default)
    context = SimpleNamespace(getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=context, conf=conf))


def test_copy_tasks_balanced_by_bytes(spark):
    from sparkwright.plans.filecopy import balance_by_bytes
    sizes = [100, 50, 50, 1, 1, 1, 1, 1] + [7] * 20
    files = spark.createDataFrame([(f"f{i}", f"g{i}", s) for i, s in enumerate(sizes)],
                                  "src string, dst string, length long").repartition(3)
    out = balance_by_bytes(files, 2)
    assert out.rdd.getNumPartitions() == 2
    rows = out.select("src", "length", "_task", F.spark_partition_id().alias("p")).collect()
    assert sorted(r.src for r in rows) == sorted(f"f{i}" for i in range(len(sizes)))
    per_task = {}
    for r in rows:
        per_task[r._task] = per_task.get(r._task, 0) + r.length
    assert len({(r._task, r.p) for r in rows}) == 2  # one task per partition
    assert max(per_task.values()) - min(per_task.values()) <= 100 // 2
