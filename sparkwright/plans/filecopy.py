"""Parallel file copy (Q14: S14 listing, K12 copy).

Files are cut into byte ranges of at most ``range_bytes``, and the ranges are
the units of work: they are dealt out to ``m`` tasks balanced by bytes, so
neither many small files nor a single huge one is left to one task. A range is
written at its place in a hidden file beside the target, the same bytes at the
same place however often a task is retried. A second job commits: for each file
whose ranges add up to its length it renames the hidden file, which is repeatable
too, and writes the file's row of the manifest. Empty folders are made; hidden
files count.

Positional writes need a mounted file system (``file``). Other schemes write
streams only, so there a file is one range.

Roots are full URIs on both sides (``sources.paths``). A file's target is the
part of its URI below the source root under the target root; a file that is not
below the root fails the job.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkwright.session import scratch_path
from sparkwright.sources.listing import list_tree
from sparkwright.sources.paths import open_fs, qualified

MANIFEST_SCHEMA = "src STRING, dst STRING, bytes BIGINT, status STRING, error STRING"
_RANGE_SCHEMA = "src STRING, dst STRING, tmp STRING, is_dir BOOLEAN, length BIGINT, bytes BIGINT, error STRING"
RANGE_BYTES = 256 << 20
_CHUNK = 8 << 20


def _copy_range(src: str, tmp: str, start: int, size: int, positional: bool) -> int:
    """Copy ``size`` bytes from ``start`` of ``src`` to the same place of ``tmp``."""
    src_fs, src_path = open_fs(src)
    dst_fs, dst_path = open_fs(tmp)
    dst_fs.create_dir(dst_path.rpartition("/")[0], recursive=True)
    if positional:
        out = os.fdopen(os.open(dst_path, os.O_WRONLY | os.O_CREAT, 0o666), "wb")
        out.seek(start)
    else:
        out = dst_fs.open_output_stream(dst_path, compression=None)
    left = size
    with src_fs.open_input_file(src_path) as fin, out:
        fin.seek(start)
        while left and (chunk := fin.read(min(_CHUNK, left))):
            out.write(chunk)
            left -= len(chunk)
    if left:
        raise EOFError(f"{src} ended {left} bytes early")
    return size


def _copier(ignore_failures: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                size, error = 0, None
                try:
                    if r.is_dir:
                        fs, path = open_fs(r.dst)
                        fs.create_dir(path, recursive=True)
                    else:
                        size = _copy_range(r.src, r.tmp, r.start, r.size, r.positional)
                except Exception as e:  # noqa: BLE001
                    if not ignore_failures:
                        raise
                    size, error = None, f"{type(e).__name__}: {e}"
                rows.append((r.src, r.dst, r.tmp, r.is_dir, r.length, size, error))
            yield pd.DataFrame(rows, columns=["src", "dst", "tmp", "is_dir", "length", "bytes", "error"])
    return run


def _commit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rename complete files; drop the hidden file of the others."""
    import pyarrow.fs as pafs
    for pdf in batches:
        rows = []
        for r in pdf.itertuples():
            status, size, error = ("folder" if r.is_dir else "copied"), r.bytes, r.error
            if pd.notna(error):
                status, size = "failed", None
            if not r.is_dir:
                fs, tmp = open_fs(r.tmp)
                there = fs.get_file_info(tmp).type == pafs.FileType.File
                if there and status == "copied":
                    fs.move(tmp, open_fs(r.dst)[1])
                elif there:
                    fs.delete_file(tmp)
                # A retried commit finds the file under its name.
                if status == "copied" and fs.get_file_info(open_fs(r.dst)[1]).size != r.length:
                    raise OSError(f"{r.dst} hasn't the {r.length} bytes of {r.src}")
            rows.append((r.src, r.dst, size, status, error))
        yield pd.DataFrame(rows, columns=["src", "dst", "bytes", "status", "error"])


def balance_by_bytes(files: DataFrame, m: int, size_col: str = "length") -> DataFrame:
    """``files`` with ``_task`` in 0..m-1, partitioned so each of ``m``
    partitions holds one task's files, and tasks balanced by bytes.

    Files in descending size (ties by ``src``) are dealt out in snake order
    (tasks 0..m-1, then m-1..0, ...), the usual greedy balance. The global
    rank comes from the rank inside each sorted partition plus an offset
    from the per-partition counts (one row per partition), so no window runs
    over all files in one task; sorting makes the ranks the same on retry.
    """
    ordered = files.orderBy(F.desc(size_col), F.asc("src")).select(
        "*", F.spark_partition_id().alias("_pid"),
        F.monotonically_increasing_id().alias("_mid"))
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_off"))
    # offsets has one row per partition of the sorted listing: a proven bound
    ranked = ordered.join(F.broadcast(offsets), "_pid").select(
        "*", (F.col("_off") + F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33))
        .alias("_rank"))
    r = F.pmod(F.col("_rank"), F.lit(2 * m))
    task = F.when(r < m, r).otherwise(F.lit(2 * m - 1) - r)
    return (ranked.withColumn("_task", task.cast("int"))
            .drop("_pid", "_mid", "_off", "_rank")
            .repartitionByRange(m, "_task"))


def plan_copy(listing: DataFrame, src_root: str, dst_root: str) -> DataFrame:
    """(src, dst, length, is_dir) of a listing of full URIs.

    The source root itself (a single file) keeps its base name below the target.
    """
    src_root, dst_root = src_root.rstrip("/"), dst_root.rstrip("/")
    below = F.substring("path", len(src_root) + 2, 1 << 30)
    name = src_root.rpartition("/")[2]
    rel = (F.when(F.col("path") == src_root, F.lit(name))
           .when(F.startswith("path", F.lit(src_root + "/")), below)
           .otherwise(F.raise_error(F.concat(F.lit("not below the source root: "), "path"))))
    return listing.select(F.col("path").alias("src"),
                          F.concat(F.lit(dst_root + "/"), rel).alias("dst"), "length", "is_dir")


def byte_ranges(pairs: DataFrame, range_bytes: int, positional: bool, copy_id: str) -> DataFrame:
    """``pairs`` with one row per byte range: tmp, start, size, positional.

    Without ``positional`` writes, for folders and for empty files there is one
    range. ``tmp`` is the hidden file of the target that all ranges share.
    """
    hidden = F.regexp_replace("dst", "([^/]+)$", f".$1.{copy_id}.tmp")
    last = F.greatest(F.col("length") - 1, F.lit(0)) if positional else F.lit(0).cast("long")
    step = F.lit(range_bytes).cast("long")
    start = F.explode(F.sequence(F.lit(0).cast("long"), last, step))
    size = F.least(step, F.col("length") - F.col("start")) if positional else F.col("length")
    return (pairs.select("*", hidden.alias("tmp"), start.alias("start"))
            .select("*", size.alias("size"), F.lit(positional).alias("positional")))


def target_is_empty(dst_root: str) -> bool:
    import pyarrow.fs as pafs
    fs, path = open_fs(dst_root)
    if fs.get_file_info(path).type == pafs.FileType.NotFound:
        return True
    return not fs.get_file_info(pafs.FileSelector(path, recursive=False))


def distcp(spark: SparkSession, src_root: str, dst_root: str, manifest: str, m: int = 3,
           ignore_failures: bool = False, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Copy everything below ``src_root`` (or that one file) to ``dst_root``
    with ``m`` parallel tasks, write the manifest to the folder ``manifest`` and
    return it: one row per file and folder. The copy has been made when this
    returns; until its commit a target file isn't there under its name.

    A non-empty target is refused unless ``ignore_failures`` (the
    reference's ``-i``), which also records copy errors in the manifest
    instead of failing the job.
    """
    src_root, dst_root = qualified(spark, src_root), qualified(spark, dst_root)
    if not ignore_failures and not target_is_empty(dst_root):
        raise FileExistsError(f"target {dst_root} is not empty")
    fs, path = open_fs(dst_root)
    fs.create_dir(path, recursive=True)  # an empty tree copies to an empty folder
    pairs = plan_copy(list_tree(spark, src_root, m), src_root, dst_root)
    ranges = byte_ranges(pairs, range_bytes, dst_root.startswith("file:"), uuid.uuid4().hex)
    done = scratch_path(spark, "copied-ranges")
    (balance_by_bytes(ranges, m, "size")
     .select("src", "dst", "tmp", "is_dir", "length", "start", "size", "positional")
     .mapInPandas(_copier(ignore_failures), _RANGE_SCHEMA).write.parquet(done))
    files = spark.read.schema(_RANGE_SCHEMA).parquet(done).groupBy(
        "src", "dst", "tmp", "is_dir", "length").agg(
        F.sum("bytes").alias("bytes"), F.first("error", ignorenulls=True).alias("error"))
    files.mapInPandas(_commit, MANIFEST_SCHEMA).write.parquet(manifest)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(manifest)
