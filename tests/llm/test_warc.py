"""WARC archives: round trip, plain expectation, determinism."""

import gzip
import hashlib
import io
from base64 import b32encode

import pytest
from pyspark.sql import functions as F

from sparkwright.llm import warc

SCHEMA = "page_id long, url string, html string"


def sha(t):
    return b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


def rows():
    out = [(i, f"http://h/{i}", f"<p>{i % 7} é</p>" * (i % 5 + 1)) for i in range(60)]
    out += [(100, None, None), (101, "http://bad url\r\nX: y", ""), (101, "again", ""),
            (102, "u", "z" * 300_000), (None, "n1", "only null"), (None, "n2", "only null"),
            (None, "n3", "<p>0 é</p>")]
    return out


def plain(data, least=0):
    """(page, bytes, digest, type, refers) per row."""
    best = {}
    for i, _, h in data:
        d = sha(h)
        best[d] = max((x for x in (best.get(d), i) if x is not None), default=None)
    out, used = [], set()
    for i, _, h in data:
        d, size = sha(h), len((h or "").encode())
        first = best[d] == i and (d not in used)
        if first:
            used.add(d)
        response = first or size < least
        out.append((str(i), size, d, "response" if response else "revisit",
                    str(None if response else best[d])))
    return sorted(out)


@pytest.mark.parametrize("least", [0, 12])
def test_round_trip(spark, scratch, least):
    df = spark.createDataFrame(rows(), SCHEMA).withColumn("shard", F.lit("clash"))
    warc.write_warc(df, scratch, roll_bytes=2000, least_payload=least)
    got = warc.read_warc(spark, scratch).collect()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type,
                   str(r.refers_to)) for r in got) == plain(rows(), least)


def files(spark, out):
    return sorted((r.path.rsplit("/", 1)[1], bytes(r.content)) for r in
                  spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(out).collect())


def test_same_archives_whatever_the_partitions(spark, scratch, monkeypatch):
    monkeypatch.setattr(warc, "LEAST_SHARD", 1000)
    made = []
    for k, n in enumerate((1, 7)):
        out = f"{scratch}/{k}"
        df = spark.createDataFrame(rows()[::-1] if k else rows(), SCHEMA).repartition(n)
        manifest = warc.write_warc(df, out, roll_bytes=700)
        listed = {r.file: r for r in manifest.collect()}
        got = files(spark, out)
        assert [n for n, _ in got] == sorted(listed)
        assert len({r.shard for r in listed.values()}) > 2 and max(r.seq for r in listed.values()) > 0
        for name, data in got:
            assert b32encode(hashlib.sha1(data).digest()).decode() == listed[name].sha1
            assert len(data) == listed[name].bytes
            records = list(warc.members(io.BytesIO(data)))
            assert len(records) == listed[name].records and b"".join(records) == gzip.decompress(data)
        made.append(got)
    assert made[0] == made[1]


def test_archives_are_read_by_many_tasks(spark, scratch):
    """The manifest is a few bytes; its archives are dealt out all the same."""
    df = spark.range(400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"),
                                 F.repeat(F.sha2(F.col("id").cast("string"), 256), 40).alias("html"))
    manifest = warc.write_warc(df, scratch, roll_bytes=4000)
    assert manifest.count() > 20
    read = warc.read_warc(spark, scratch)
    assert read.count() == 400
    at_work = read.select(F.spark_partition_id().alias("p")).distinct().count()
    assert at_work > min(4, spark.sparkContext.defaultParallelism - 1)


def test_broken_records_raise():
    r = warc.make_record(1, "u", b"abc", sha("abc"), 0, None)
    assert warc.parse_record(r)["payload"] == b"abc"
    for bad in (r.replace(b"abc", b"abd"), r[:-1], b"x" + r, r.replace(sha("abc").encode(), sha("b").encode())):
        with pytest.raises(ValueError):
            warc.parse_record(bad)
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(gzip.compress(r)[:-9])))


def test_empty(spark, scratch):
    warc.write_warc(spark.createDataFrame([], SCHEMA), scratch)
    assert warc.read_warc(spark, scratch).count() == 0
