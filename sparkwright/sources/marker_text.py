"""Read a marker-text file (``functions.marker``) back into lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkwright.functions.marker import marker_decode


def read_marker_text(spark: SparkSession, path: str, mode: str = "clean") -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(marker_decode("value", mode).alias("value"))
