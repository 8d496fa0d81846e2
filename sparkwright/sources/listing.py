"""File listing (S14): a tree walked by tasks, level by level.

The frontier is a table of folders. Each round its rows are spread over tasks;
a task lists its folders and goes on into what it finds until it has listed
``budget`` entries, then hands the folders it hasn't entered back as the next
frontier. Every round's rows are written to the shared scratch folder, so a lost
task lists its folders again and nothing is listed by the driver. A deep chain
takes one round per ``budget`` folders; one flat folder is one task, whose
entries are written as they come.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.session import scratch_path
from sparkwright.sources.paths import open_fs, qualified

TREE_SCHEMA = "path STRING, length BIGINT, is_dir BOOLEAN, modification_time TIMESTAMP"
_ROUND_SCHEMA = TREE_SCHEMA + ", todo BOOLEAN"
#: Entries that a task lists before it hands folders back; rows per output batch.
BUDGET, _ROWS = 20_000, 10_000


def _entry(uri: str, info, folder: bool, todo: bool = False) -> tuple:
    import pandas as pd
    return (uri, 0 if folder else info.size, folder,
            pd.NaT if info is None or info.mtime is None else pd.Timestamp(info.mtime_ns, tz="UTC"),
            todo)


def _frame(rows: list[tuple]):
    import pandas as pd
    out = pd.DataFrame(rows, columns=["path", "length", "is_dir", "modification_time", "todo"])
    out["modification_time"] = pd.to_datetime(out["modification_time"], utc=True).astype(
        "datetime64[us, UTC]")
    return out


def _lister(budget: int):
    def run(batches):
        import pyarrow.fs as pafs
        for pdf in batches:
            for top in pdf["path"]:
                waiting, rows, listed = [top], [], 0
                while waiting and listed < budget:
                    uri = waiting.pop()
                    fs, path = open_fs(uri)
                    for info in fs.get_file_info(pafs.FileSelector(path, recursive=False)):
                        listed += 1
                        folder = info.type == pafs.FileType.Directory
                        here = f"{uri}/{info.base_name}"
                        if folder:
                            waiting.append(here)
                        rows.append(_entry(here, info, folder))
                        if len(rows) == _ROWS:
                            yield _frame(rows)
                            rows = []
                rows += [_entry(uri, None, True, todo=True) for uri in waiting]
                if rows:
                    yield _frame(rows)
    return run


def list_tree(spark: SparkSession, root: str, tasks: int | None = None,
              budget: int = BUDGET) -> DataFrame:
    """(path, length, is_dir, modification_time) of all files and folders below
    ``root``, hidden ones included, or of the single file ``root``.

    Paths are full URIs. Folders have length 0; a store that keeps no folder
    times gives null. The driver only asks what ``root`` is. A round uses
    ``tasks`` tasks (default: the default parallelism).
    """
    import pyarrow.fs as pafs
    root = qualified(spark, root)
    fs, top = open_fs(root)
    info = fs.get_file_info(top)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(root)
    if info.type == pafs.FileType.File:
        return spark.createDataFrame(_frame([_entry(root, info, False)]), _ROUND_SCHEMA).drop("todo")
    n = tasks or spark.sparkContext.defaultParallelism
    frontier, rounds = spark.createDataFrame([(root,)], "path STRING"), []
    while not rounds or not frontier.isEmpty():
        rounds.append(f"{scratch_path(spark, 'listing')}")
        # A number of partitions that AQE leaves alone: the rows are tiny, the work isn't.
        (frontier.repartition(n, F.xxhash64("path"))
         .mapInPandas(_lister(budget), _ROUND_SCHEMA).write.parquet(rounds[-1]))
        frontier = spark.read.schema(_ROUND_SCHEMA).parquet(rounds[-1]).filter("todo").select("path")
    return spark.read.schema(_ROUND_SCHEMA).parquet(*rounds).filter("not todo").drop("todo")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Recursive listing of files (path, length, modification_time), hidden
    files included."""
    return list_tree(spark, path).filter("not is_dir").drop("is_dir")
