"""Deterministic sharded WARC writer and its reader.

Records are ordered by (page_id, payload digest), nulls last. Byte prefix sums
over that order cut the records into shards by data alone, so a rerun or a
retried task writes the same archives whatever the partitioning. Payloads cross
the network once: each record goes to its shard's task and is sorted there. The
task streams them into files of one gzip member per record, closing a file when
its compressed size passes the roll limit. Files appear under temporary names
and are renamed when complete; the job ends by renaming a manifest into place,
and readers open only the files that it lists.

Of records with equal payloads that with the largest page_id is the response,
the others are revisits that refer to it. Which page that is comes from a
partial aggregate over digests, so a payload shared by a third of the pages is
no hot group. Those (page, digest) -> page rows meet their records in the
writer's sort.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.llm.common import materialise
from sparkwright.llm.sharding import prefix_sums
from sparkwright.sources.paths import open_fs, qualified

#: A shard is one task's work: the total over SHARDS bytes, within these bounds.
SHARDS, LEAST_SHARD, MOST_SHARD = 4096, 4 << 20, 1 << 30
ROLL_BYTES = 256 << 20
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Compressed bytes of archives for one reading task.
READ_BYTES = 128 << 20
_CHUNK = 1 << 20


def _sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id, digest: str, nth: int) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}:{digest}:{nth}>"


def header_value(value: str) -> str:
    """A header value in one line: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", value)


def make_record(page_id, url: str | None, payload: bytes, digest: str, nth: int,
                refers_to: str | None) -> bytes:
    """One record, uncompressed; ``refers_to`` (a record id) makes it a revisit."""
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             b"Content-Length: %d\r\n\r\n" % len(payload))
    if refers_to is None:
        block += payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {record_id(page_id, digest, nth)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {header_value(url)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {REVISIT}"]
    lines += ["Content-Type: application/http; msgtype=response",
              f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{_sha1(block)}",
              f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Archive:
    """One archive file being written under a temporary name."""

    def __init__(self, out: str, shard: int, seq: int):
        self.fs, base = open_fs(out)
        self.name, self.shard, self.seq = f"warc-{shard:08d}-{seq:05d}.warc.gz", shard, seq
        self.final = f"{base}/{self.name}"
        self.temporary = f"{base}/_temporary/{self.name}.{uuid.uuid4().hex}"
        self.fs.create_dir(f"{base}/_temporary", recursive=True)
        self.stream = self.fs.open_output_stream(self.temporary, compression=None)
        self.records = self.bytes = 0
        self.digest = hashlib.sha1()

    def add(self, record: bytes, level: int) -> None:
        pack = zlib.compressobj(level, zlib.DEFLATED, 31)
        data = pack.compress(record) + pack.flush()
        self.stream.write(data)
        self.digest.update(data)
        self.records += 1
        self.bytes += len(data)

    def close(self) -> tuple:
        self.stream.close()
        try:
            self.fs.move(self.temporary, self.final)
        except OSError:  # some stores refuse to replace what an earlier attempt left
            self.fs.delete_file(self.final)
            self.fs.move(self.temporary, self.final)
        return (self.name, self.shard, self.seq, self.records, self.bytes,
                base64.b32encode(self.digest.digest()).decode())


_MANIFEST = "file string, shard int, seq int, records long, bytes long, sha1 string"


def _write_archives(out: str, roll_bytes: int, least_payload: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, archive, seq = [], None, 0
        key = canon = shard = None
        nth = 0
        for b in batches:
            kinds, shards = b.column("kind").to_pylist(), b.column("shard").to_pylist()
            pages, digests = b.column("page_id").to_pylist(), b.column("sha1").to_pylist()
            targets, urls = b.column("refers_to").to_pylist(), b.column("url").to_pylist()
            htmls = b.column("html")
            for i, kind in enumerate(kinds):
                if kind == 0:  # names the response for the records of this page and payload
                    key, canon, nth = (pages[i], digests[i]), targets[i], 0
                    continue
                if key != (pages[i], digests[i]):
                    raise ValueError(f"no reference row for page {pages[i]}")
                payload = (htmls[i].as_py() or "").encode("utf-8", "replace")
                digest = _sha1(payload)
                first = pages[i] == canon and nth == 0
                refers = None if first or len(payload) < least_payload \
                    else record_id(canon, digest, 0)
                if shard != shards[i]:
                    if archive is not None:
                        done.append(archive.close())
                    archive, seq, shard = None, 0, shards[i]
                if archive is None:
                    archive = _Archive(out, shard, seq)
                archive.add(make_record(pages[i], urls[i], payload, digest, nth, refers), level)
                nth += 1
                if archive.bytes >= roll_bytes:
                    done.append(archive.close())
                    archive, seq = None, seq + 1
        if archive is not None:
            done.append(archive.close())
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[k] for d in done], t) for k, t in enumerate(
                (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()))],
            names=["file", "shard", "seq", "records", "bytes", "sha1"])
    return run


def write_warc(pages: DataFrame, out: str, roll_bytes: int = ROLL_BYTES, least_payload: int = 0,
               level: int = 5) -> DataFrame:
    """Write ``pages`` (page_id, url, html) under the new folder ``out`` and
    return the committed manifest: file, shard, seq, records, bytes, sha1.

    A null html is an empty payload, a null url gives a record without target.
    Records with payloads under ``least_payload`` bytes are all responses. Equal
    payloads: the largest page_id is the response (its first record, if rows
    repeat it); null ids rank lowest, and if all are null the first in order is.
    Other columns are ignored. No pages give an empty manifest.
    """
    spark = pages.sparkSession
    out = qualified(spark, out)
    id_type = pages.schema["page_id"].dataType.simpleString()
    page = pages.select("page_id", "url", "html", F.sha1(
        F.coalesce("html", F.lit("")).cast("binary")).alias("sha1"))
    narrow = materialise(page.select(
        "page_id", "sha1", F.coalesce(F.octet_length("html"), F.lit(0)).cast("long").alias("size")),
        "warc-pages")
    total = narrow.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    shard_bytes = min(MOST_SHARD, max(LEAST_SHARD, total // SHARDS))
    keys = narrow.groupBy("page_id", "sha1").agg(F.sum("size").alias("size"))
    placed = materialise(
        prefix_sums(keys, ["page_id", "sha1"], "size")
        .select("page_id", "sha1", F.expr(f"before div {shard_bytes}").cast("int").alias("shard")),
        "warc-shards")
    canon = materialise(narrow.groupBy("sha1").agg(F.max("page_id").alias("refers_to")),
                        "warc-canon")
    # One cut per shard: their number is bounded by SHARDS or by total / MOST_SHARD.
    cuts = [(r.k[0], r.k[1], r.k[2], r.shard) for r in placed.groupBy("shard").agg(
        F.min(F.struct(F.col("page_id").isNull(), "page_id", "sha1")).alias("k")).collect()]
    cuts = sorted(((c[0], "" if c[1] is None else c[1], c[2]), c[3]) for c in cuts)
    starts, numbers = [c[0] for c in cuts], [c[1] for c in cuts]

    def shard_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, digests = b.column("page_id").to_pylist(), b.column("sha1").to_pylist()
            shard = [numbers[bisect_right(starts, (i is None, "" if i is None else i, d)) - 1]
                     for i, d in zip(ids, digests)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shard, pa.int32())],
                                             names=[*b.schema.names, "shard"])

    records = page.mapInArrow(
        shard_of, f"page_id {id_type}, url string, html string, sha1 string, shard int")
    none = F.lit(None)
    rows = (placed.join(canon, "sha1")
            .select("shard", F.lit(0).alias("kind"), "page_id", "sha1", "refers_to",
                    none.cast("string").alias("url"), none.cast("string").alias("html"))
            .unionByName(records.select(
                "shard", F.lit(1).alias("kind"), "page_id", "sha1",
                none.cast(id_type).alias("refers_to"), "url", "html")))
    order = ["shard", F.col("page_id").asc_nulls_last(), "sha1", "kind", "url"]
    manifest = (rows.repartition(max(1, len(cuts)), "shard").sortWithinPartitions(*order)
                .mapInArrow(_write_archives(out, roll_bytes, least_payload, level), _MANIFEST))
    manifest.write.parquet(f"{out}/_manifest.tmp")
    _commit(spark, out)
    return spark.read.schema(_MANIFEST).parquet(f"{out}/_manifest")


def _commit(spark: SparkSession, out: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(out).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.rename(path(f"{out}/_manifest.tmp"), path(f"{out}/_manifest")):
        raise OSError(f"the manifest can't be renamed in {out}")
    fs.delete(path(f"{out}/_temporary"), True)


def members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, each decompressed, read chunk by chunk."""
    rest, unpack, parts = b"", None, []
    while True:
        data = rest or stream.read(_CHUNK)
        rest = b""
        if not data:
            if unpack is not None:
                raise ValueError("the archive ends inside a record")
            return
        if unpack is None:
            unpack, parts = zlib.decompressobj(31), []
        parts.append(unpack.decompress(data))
        if unpack.eof:
            rest, unpack = unpack.unused_data, None
            yield b"".join(parts)


def parse_record(record: bytes) -> dict:
    """Headers and block of a record; raises if lengths or digests disagree."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    length = int(fields["Content-Length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"wrong length of {fields['WARC-Record-ID']}")
    if fields["WARC-Block-Digest"] != f"sha1:{_sha1(block)}":
        raise ValueError(f"wrong block digest of {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http).group(1))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or _sha1(payload) != digest):
        raise ValueError(f"wrong payload of {fields['WARC-Record-ID']}")
    return {"fields": fields, "payload": payload, "payload_bytes": size, "payload_digest": digest}


def _page_of(urn: str | None, number: bool):
    if urn is None:
        return None
    page = urn.removeprefix("<urn:x-page:").rsplit(":", 2)[0]
    return None if page == "" else int(page) if number else page


def _read_archives(out: str, id_type: pa.DataType):
    number = pa.types.is_integer(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(out)
        for b in batches:
            for name in b.column("file").to_pylist():
                rows: list[tuple] = []
                with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for raw in members(stream):
                        r = parse_record(raw)
                        f = r["fields"]
                        rows.append((
                            _page_of(f["WARC-Record-ID"], number), f.get("WARC-Target-URI"),
                            f["WARC-Type"], r["payload_bytes"], r["payload_digest"],
                            _page_of(f.get("WARC-Refers-To"), number)))
                        if len(rows) == 5000:
                            yield batch(rows)
                            rows = []
                if rows:
                    yield batch(rows)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        types = (id_type, pa.string(), pa.string(), pa.int64(), pa.string(), id_type)
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)],
            names=["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"])
    return run


def read_warc(spark: SparkSession, out: str, id_type: str = "bigint") -> DataFrame:
    """The records of all archives in the manifest under ``out``: page_id, url,
    record_type, payload_bytes, payload_digest, refers_to. Every record's
    lengths and digests are checked. Archives are dealt out to tasks of about
    READ_BYTES compressed bytes."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string
    out = qualified(spark, out)
    manifest = spark.read.schema(_MANIFEST).parquet(f"{out}/_manifest")
    arrow_type = to_arrow_type(_parse_datatype_string(id_type))
    files, total = manifest.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    tasks = max(min(files, spark.sparkContext.defaultParallelism), -(-total // READ_BYTES), 1)
    # A named number: by size alone AQE would make one task of the manifest's few bytes.
    return (manifest.repartition(tasks, "file").select("file").mapInArrow(
        _read_archives(out, arrow_type),
        f"page_id {id_type}, url string, record_type string, payload_bytes long,"
        f" payload_digest string, refers_to {id_type}"))


_HEX5 = "CAST('0x' || substr(h, {at}, 5) AS BIGINT)"
_B32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (({_HEX5.format(at=1 + 5 * k)}) >> {shift}) % 32, 1)"
    for k in range(8) for shift in (15, 10, 5, 0))
ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
c AS (SELECT h, max(page_id) AS canon FROM p GROUP BY h)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_B32} AS payload_digest,
       CASE WHEN page_id = canon THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = canon THEN NULL ELSE canon END AS refers_to
FROM p JOIN c USING (h)
"""
