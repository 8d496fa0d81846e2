"""Files by full URI, on the driver (Hadoop file systems) and in Python workers.

Spark qualifies a path by its scheme or by ``fs.defaultFS``; Python workers
have no Hadoop client, so ``open_fs`` maps the schemes that pyarrow knows.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Scheme -> pyarrow's name for it.
SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs",
           "abfs": "abfs", "abfss": "abfss"}


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as a full URI of the file system that Spark would use for it,
    without a trailing slash."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = fs.makeQualified(jpath).toString()
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return uri.rstrip("/")


def open_fs(uri: str):
    """(pyarrow file system, path in it) of a full URI.

    Works for file, hdfs, s3 (s3a, s3n), gs and abfs(s); other schemes raise.
    """
    import pyarrow.fs
    scheme, _, rest = uri.partition("://")
    if scheme not in SCHEMES or not rest:
        raise ValueError(f"no Python file system for {uri}")
    if scheme == "file":
        return pyarrow.fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(f"{SCHEMES[scheme]}://{rest}")
