"""File sources (S1-S8): thin, declarative readers. S14 is in ``listing.py``.

All readers return lazy DataFrames so Catalyst can push filters and column
pruning into the scan. Schemas are passed explicitly wherever the caller
knows them; inference is only used where the reference relies on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwright.functions.text import java_trim

# Names of the driver-generated tables (one parquet file each).
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one fixture table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan."""
    return spark.read.parquet(path)


def read_csv_untyped(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV without header or schema: every column a string named _c0.._cN."""
    return spark.read.option("sep", sep).option("header", False).option(
        "inferSchema", False).csv(path)


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType | str,
                   sep: str = ";", header: bool = True) -> DataFrame:
    """S3: CSV with a fixed schema; columns bind by position, header skipped."""
    return (spark.read.schema(schema).option("sep", sep).option("header", header)
            .option("enforceSchema", True).csv(path))


def read_json(spark: SparkSession, path: str,
              schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines. Pass a schema in production to skip the inference pass."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    """ORC scan."""
    return spark.read.orc(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line, column ``value``. Only a newline ends a line."""
    return spark.read.option("lineSep", "\n").text(path)


def read_whole_files(spark: SparkSession, path: str, name_from: str | None = None) -> DataFrame:
    """One row per file: ``file_name`` and whole ``content``.

    ``file_name`` is the base name of the path (as the reference names files),
    or, with ``name_from``, the value of that partition-folder column
    (``<name_from>=<value>/``), which stays stable across rewrites.
    """
    files = spark.read.text(path, wholetext=True)
    if name_from is None:
        name = F.col("_metadata.file_name")
    elif name_from in files.columns:
        name = F.col(name_from).cast("string")
    else:  # no partition folders at all: an empty tree
        name = F.lit(None).cast("string")
    return files.select(name.alias("file_name"), F.col("value").alias("content"))


def delimited_to_rows(lines: DataFrame, names: str | Sequence[str], sep: str = ",",
                      trim_last: bool = True, on_short: str = "fail",
                      value_col: str = "value") -> DataFrame:
    """Split text lines into string columns named by a run-time name list.

    ``names`` may be one space-separated string, as in the reference. The
    last field is trimmed of characters up to U+0020. A line with too few fields
    fails the job; ``on_short="null"`` fills nulls instead.
    """
    cols = names.split(" ") if isinstance(names, str) else list(names)
    parts = F.split(F.col(value_col), _java_regex_literal(sep), -1)
    exprs = []
    for i, name in enumerate(cols):
        item = F.get(parts, i) if on_short == "null" else F.element_at(parts, i + 1)
        if trim_last and i == len(cols) - 1:
            item = java_trim(item)
        exprs.append(item.cast("string").alias(name))
    out = lines.select(*exprs)
    if on_short == "fail":
        # element_at past the end raises under ANSI mode; make it explicit
        # for non-ANSI sessions as well.
        check = F.when(F.size(parts) < len(cols),
                       F.raise_error(F.lit(f"line has fewer than {len(cols)} fields")))
        out = lines.select(*exprs, check.alias("_chk")).drop("_chk")
    return out


def schema_from_names(names: str | Sequence[str]) -> T.StructType:
    """All-nullable string schema from a space-separated name string."""
    cols = names.split(" ") if isinstance(names, str) else list(names)
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols])


def _java_regex_literal(sep: str) -> str:
    special = set("\\^$.|?*+()[]{}")
    return "".join("\\" + ch if ch in special else ch for ch in sep)
