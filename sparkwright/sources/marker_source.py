"""The marker-text format by name (S15, K8): ``USING marker`` in SQL.

After ``register(spark)`` the format works wherever a format name does:

    CREATE TEMPORARY VIEW t USING marker OPTIONS (path 'file:///...', mode 'clean');
    INSERT INTO t SELECT line FROM lines;
    SELECT value FROM t;

(A catalog table USING a Python source doesn't hand its options on in Spark 4.1;
there each statement names the path: ``SELECT * FROM t WITH (path = '...')``. A
view lists its files once, when it is first read: make it anew after a write.)

The reader cuts files into byte ranges; a range owns the lines that start in it,
so one large file is many tasks. The writer's tasks write files of their own into
a temporary folder and the commit moves those that it was told of, so a retried or
abandoned attempt leaves nothing behind. Options: ``mode`` (clean or compat),
``gap`` (2 to 255; default: from a hash of each line) and ``split_bytes``.

The path is a full URI. Hidden files are skipped.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader,
                                    InputPartition, WriterCommitMessage)
from pyspark.sql.types import StringType, StructField, StructType

from sparkwright.functions.marker import GAP_CHOICES, GAP_MIN, TOKEN_PATTERN
from sparkwright.sources.paths import open_fs

SPLIT_BYTES = 128 << 20
_READ, _LINES = 1 << 20, 4096
_SCHEMA = StructType([StructField("value", StringType())])


def encode_line(line: str | None, gap: int | None = None) -> str:
    """A line of a marker file: ``functions.marker`` states the rules. A null is an
    empty line. Without ``gap`` it is 2 + crc32(line) mod 254."""
    line = line or ""
    words = line.rstrip(" ").split(" ") if line.rstrip(" ") or not line else []
    gap = gap or GAP_MIN + zlib.crc32(line.encode()) % GAP_CHOICES
    token = f"g{'e' * gap}k "
    return "".join(f"{w} {token if i and i % gap == 0 else ''}" for i, w in enumerate(words))


def decode_line(line: str, mode: str) -> str:
    if mode == "compat":
        return re.sub(TOKEN_PATTERN, "", line)
    return re.sub(" \\Z", "", re.sub(TOKEN_PATTERN + " ", "", line))


def _uri(options) -> str:
    path = options.get("path", "")
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    if "://" not in path:
        raise ValueError(f"marker: the path must be a full URI, not {path!r}")
    return path.rstrip("/")


def _files(uri: str) -> list[tuple[str, int]]:
    """(path below ``uri``, size) of the visible files of a folder; none if it isn't there."""
    import pyarrow.fs as pafs
    fs, top = open_fs(uri)
    found = fs.get_file_info(pafs.FileSelector(top, recursive=True, allow_not_found=True))
    names = [(f.path[len(top):].lstrip("/"), f) for f in found if f.type == pafs.FileType.File]
    return sorted((n, f.size) for n, f in names if not re.search(r"(^|/)[._]", n))


@dataclass
class _Range(InputPartition):
    uri: str
    start: int
    stop: int


class MarkerReader(DataSourceReader):
    def __init__(self, options):
        self.uri, self.mode = _uri(options), options.get("mode", "clean")
        if self.mode not in ("clean", "compat"):
            raise ValueError("mode must be 'compat' or 'clean'")
        self.split = int(options.get("split_bytes", SPLIT_BYTES))

    def partitions(self) -> list[InputPartition]:
        return [_Range(f"{self.uri}/{name}", a, min(a + self.split, size))
                for name, size in _files(self.uri) for a in range(0, size, self.split)]

    def read(self, partition: _Range | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # how Spark reads a source without partitions
            return
        lines = []
        for line in _lines(partition.uri, partition.start, partition.stop):
            lines.append(decode_line(line.decode("utf-8", "replace"), self.mode))
            if len(lines) == _LINES:
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
                lines = []
        if lines:
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])


def _lines(uri: str, start: int, stop: int) -> Iterator[bytes]:
    """The lines of a file that start in [start, stop); only a newline ends a line."""
    fs, path = open_fs(uri)
    with fs.open_input_file(path) as f:
        # The byte before tells whether a line starts at ``start`` itself.
        f.seek(max(0, start - 1))
        at, held, skipping = max(0, start - 1), [], start > 0
        while at < stop or held:
            chunk = f.read(_READ)
            if not chunk:
                break
            *whole, rest = chunk.split(b"\n")
            for piece in whole:
                if skipping:
                    skipping = False
                elif held or at < stop:
                    yield b"".join([*held, piece])
                held = []
                at += len(piece) + 1
                if at >= stop and not skipping:
                    return
            if rest and not skipping:
                held.append(rest)
            at += len(rest)
        if held:
            yield b"".join(held)


@dataclass
class _Written(WriterCommitMessage):
    name: str | None


class MarkerWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.uri, self.overwrite = _uri(options), overwrite
        self.gap = int(options["gap"]) if "gap" in options else None
        if self.gap is not None and not GAP_MIN <= self.gap < GAP_MIN + GAP_CHOICES:
            raise ValueError("gap must be 2 to 255")
        self.temporary = f"_temporary-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        name = f"part-{uuid.uuid4().hex}.txt"  # one per attempt
        fs, folder = open_fs(f"{self.uri}/{self.temporary}")
        fs.create_dir(folder, recursive=True)
        rows = 0
        with fs.open_output_stream(f"{folder}/{name}", compression=None) as out:
            for batch in batches:
                rows += len(batch)
                out.write("".join(f"{encode_line(v, self.gap)}\n"
                                  for v in batch.column(0).to_pylist()).encode())
        return _Written(name if rows else None)

    def commit(self, messages: list[_Written | None]) -> None:
        fs, top = open_fs(self.uri)
        fs.create_dir(top, recursive=True)
        before = _files(self.uri) if self.overwrite else []
        for m in messages:
            if m is not None and m.name is not None:
                fs.move(f"{top}/{self.temporary}/{m.name}", f"{top}/{m.name}")
        for name, _ in before:
            fs.delete_file(f"{top}/{name}")
        self._drop(fs, top)

    def abort(self, messages: list[_Written | None]) -> None:
        self._drop(*open_fs(self.uri))

    def _drop(self, fs, top: str) -> None:
        import pyarrow.fs as pafs
        if fs.get_file_info(f"{top}/{self.temporary}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{top}/{self.temporary}")


class MarkerDataSource(DataSource):
    """Format ``marker``: one string column ``value``, a row per line."""

    @classmethod
    def name(cls) -> str:
        return "marker"

    def schema(self) -> StructType:
        return _SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return MarkerReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if [f.dataType for f in schema] != [StringType()]:
            raise ValueError("marker: rows have one string column")
        return MarkerWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(MarkerDataSource)
