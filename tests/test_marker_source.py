"""The marker format by name: SQL round trips, byte ranges, retries and aborts."""

import os
import random
import re

import pytest

import pyarrow as pa
from pyspark.sql import functions as F

from sparkwright.functions.marker import marker_decode
from sparkwright.sources import marker_source as ms


@pytest.fixture(scope="module", autouse=True)
def marker(spark):
    ms.register(spark)


def view(spark, scratch, name, **options):
    given = ", ".join(f"{k} '{v}'" for k, v in {"path": f"file://{scratch}", **options}.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} USING marker OPTIONS ({given})")


LINES = ["", " ", "a", "a b  c", " lead", "tail  ", "x " * 700 + "y", "é 😀 geek", "tab\tand\rcr",
         *[" ".join(f"w{i}" for i in range(n)) for n in (3, 255, 256, 2000)]]


def restored(line):
    """What a round trip in clean mode gives: tokens and trailing blanks go."""
    return re.sub("gee+k ", "", line.rstrip(" ") + " ")[:-1] if line.strip(" ") else ""


@pytest.mark.parametrize("split", [9, 1000, 10 ** 9])
def test_sql_round_trip_in_ranges(spark, scratch, split):
    def read():
        view(spark, scratch, "mk", split_bytes=split)
        return sorted(r.value for r in spark.sql("SELECT value FROM mk").collect())
    assert read() == []  # nothing there yet
    few = LINES[:6] if split == 9 else LINES
    spark.createDataFrame([(x,) for x in few], "line string").createOrReplaceTempView("mk_lines")
    spark.sql("INSERT INTO mk SELECT line FROM mk_lines")
    want = sorted(restored(x) for x in few)
    assert read() == want
    spark.sql("INSERT INTO mk SELECT line FROM mk_lines")
    assert len(read()) == 2 * len(few)
    spark.sql("INSERT OVERWRITE mk SELECT 'only'")
    assert read() == ["only"]
    assert all(not f.startswith("_") for f in os.listdir(scratch))


def test_the_column_reader_reads_the_same_files(spark, scratch):
    """Both readers decode both writers' files, in both modes."""
    view(spark, scratch, "mk", gap=3)
    spark.createDataFrame([(x,) for x in LINES], "line string").createOrReplaceTempView("mk_lines")
    spark.sql("INSERT INTO mk SELECT line FROM mk_lines")
    text = spark.read.option("lineSep", "\n").text(scratch)
    for mode in ("clean", "compat"):
        view(spark, scratch, "mk2", mode=mode)
        assert sorted(r.value for r in spark.table("mk2").collect()) == sorted(
            r.v for r in text.select(marker_decode("value", mode).alias("v")).collect())


def test_encoding_equals_the_column_expression(spark):
    from sparkwright.functions.marker import marker_encode
    for gap in (2, 7, 255):
        got = spark.createDataFrame([(x,) for x in LINES], "value string").select(
            "value", marker_encode("value", gap).alias("e")).collect()
        assert {r.value: r.e for r in got} == {x: ms.encode_line(x, gap) for x in LINES}
    assert ms.encode_line(None) == ms.encode_line("")


def test_ranges_own_each_line_once(tmp_path):
    rng = random.Random(4)
    lines = ["x" * rng.choice([0, 0, 1, 5, 40, 300]) for _ in range(200)]
    for end in ("\n", ""):
        path = tmp_path / f"f{len(end)}"
        path.write_bytes(("\n".join(lines) + "y" + end).encode())
        want = [x.encode() for x in lines[:-1]] + [(lines[-1] + "y").encode()]
        size = path.stat().st_size
        for step in (1, 2, 3, 17, 100, 301, size, size + 9):
            got = [x for a in range(0, size, step)
                   for x in ms._lines(f"file://{path}", a, min(a + step, size))]
            assert got == want, step


def test_ranges_across_read_buffers(tmp_path, monkeypatch):
    monkeypatch.setattr(ms, "_READ", 5)
    path = tmp_path / "f"
    path.write_bytes(b"ab\n\n" + b"z" * 23 + b"\nend")
    got = [x for a in range(0, 31, 4) for x in ms._lines(f"file://{path}", a, min(a + 4, 31))]
    assert got == [b"ab", b"", b"z" * 23, b"end"]


def test_a_retried_task_and_an_aborted_job_leave_nothing(tmp_path):
    batch = pa.RecordBatch.from_arrays([pa.array(["a b", None])], ["value"])
    options = {"path": f"file://{tmp_path}"}
    writer = ms.MarkerWriter(options, False)

    def dies():
        yield batch
        raise RuntimeError("executor lost")
    with pytest.raises(RuntimeError):
        writer.write(dies())
    kept, empty = writer.write(iter([batch])), writer.write(iter([]))
    assert ms._files(options["path"]) == []  # not visible before the commit
    writer.commit([kept, empty, None])
    ((name, _),) = ms._files(options["path"])
    assert (tmp_path / name).read_text() == "a b \n \n"
    assert os.listdir(tmp_path) == [name]
    other = ms.MarkerWriter(options, True)
    other.write(iter([batch]))
    other.abort([None])
    assert os.listdir(tmp_path) == [name]


def test_bad_options(spark, scratch):
    for options in ({"mode": "odd"}, {"path": "/no/scheme"}):
        view(spark, scratch, "mk", **options)
        with pytest.raises(Exception, match="mode must be|full URI"):
            spark.table("mk").collect()
    view(spark, scratch, "mk", gap=1)
    with pytest.raises(Exception, match="gap must be"):
        spark.sql("INSERT INTO mk SELECT 'x'")
    view(spark, scratch, "mk")
    with pytest.raises(Exception):
        spark.sql("INSERT INTO mk SELECT 5, 'x'")


def test_sql_functions_have_no_python(spark):
    from sparkwright.functions.udfs import register_sql
    register_sql(spark)
    df = spark.createDataFrame([(1, '["a", null]', 6.0), (2, "[]", 2.0), (3, '["c"]', None)],
                               "id int, j string, v double")
    df.createOrReplaceTempView("sw_fn")
    q = spark.sql("SELECT id, items FROM sw_fn, LATERAL json_array_rows(j) WHERE gt_five(v)")
    assert sorted(map(str, map(tuple, q.collect()))) == ["(1, 'a')", "(1, None)"]
    guard = spark.sql("SELECT null_or_empty_guard(s) AS g FROM VALUES (''), ('x'), (NULL) AS t(s)")
    assert sorted(map(str, (r.g for r in guard.collect()))) == ["", "None", "None"]
    for d in (q, guard):
        assert "Python" not in d._jdf.queryExecution().executedPlan().toString()
    for bad in ("[1, 2", None):
        df.withColumn("j", F.lit(bad)).createOrReplaceTempView("sw_fn_bad")
        with pytest.raises(Exception, match="not a JSON array"):
            spark.sql("SELECT items FROM sw_fn_bad, LATERAL json_array_rows(j)").collect()
