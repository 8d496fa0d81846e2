"""Wide-column cells (S16, K10, K11), re-aimed on DataFrames and the catalog.

A wide-column table is kept in long form: one row per cell
``(row_key, family, qualifier, ts, value)``. A put is an append of cells
with a newer ``ts``; a scan resolves the latest version of every cell. Hot
row keys are harmless: resolution is a partial-aggregated ``max_by`` per
(row_key, family, qualifier).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.sinks.upsert import latest_per_key

CELL_KEYS = ("row_key", "family", "qualifier")
CELL_SCHEMA = "row_key STRING, family STRING, qualifier STRING, ts BIGINT, value STRING"


def to_cells(df: DataFrame, row_key: str, families: Mapping[str, Mapping[str, str]],
             ts: int = 1) -> DataFrame:
    """Melt a wide DataFrame into cells.

    ``families`` maps family -> {qualifier: source column}. Values are stored
    as strings (cells hold bytes in the reference).
    """
    parts = []
    for family, quals in families.items():
        for qualifier, col in quals.items():
            parts.append(F.struct(F.lit(family).alias("family"),
                                  F.lit(qualifier).alias("qualifier"),
                                  F.col(col).cast("string").alias("value")))
    return (df.select(F.col(row_key).cast("string").alias("row_key"),
                      F.explode(F.array(*parts)).alias("c"))
            .select("row_key", "c.family", "c.qualifier", F.lit(ts).cast("long").alias("ts"),
                    "c.value"))


def put(cells: DataFrame, updates: DataFrame) -> DataFrame:
    """Upsert cells; for each (row_key, family, qualifier) the value with
    the highest ``ts`` wins."""
    both = cells.select(*CELL_KEYS, "ts", "value").unionByName(
        updates.select(*CELL_KEYS, "ts", "value"))
    return latest_per_key(both, list(CELL_KEYS), "ts", ["value"]).select(
        *CELL_KEYS, "ts", "value")


def scan(cells: DataFrame) -> DataFrame:
    """All cells in (row_key, family, qualifier) order."""
    return cells.orderBy(*CELL_KEYS)


def wide_view(cells: DataFrame, qualifiers: Sequence[str]) -> DataFrame:
    """One row per row key, one column per qualifier (known list: no extra
    pass to discover the columns), holding the cell's latest value, so the
    result is the same on resolved and unresolved cells. Qualifier names
    must be unique across families."""
    return (cells.groupBy("row_key").pivot("qualifier", list(qualifiers))
            .agg(F.max_by("value", "ts")))


# Table lifecycle on the Spark catalog (external tables in a given folder).

def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def list_tables(spark: SparkSession) -> list[str]:
    return [t.name for t in spark.catalog.listTables()]


def create_table_if_absent(spark: SparkSession, name: str, path: str,
                           seed: DataFrame | None = None) -> bool:
    """Create an external cell table at ``path`` unless it exists; returns
    True when created. ``seed`` cells are written first."""
    if spark.catalog.tableExists(name):
        return False
    if seed is not None:
        seed.write.mode("overwrite").parquet(path)
        spark.catalog.createTable(name, path=path, source="parquet")
    else:
        spark.catalog.createTable(name, path=path, source="parquet", schema=_schema(spark))
    return True


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _schema(spark: SparkSession):
    return spark.createDataFrame([], CELL_SCHEMA).schema
