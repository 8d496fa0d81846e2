"""Topic sources (S11, S12): a stream of (offset, key, value) strings.

``fmt="kafka"`` uses Spark's Kafka source (the ``spark-sql-kafka`` package
must be on the classpath; it is not in this container). ``fmt="files"``
reads the same three columns from files dropped into a folder - the stand-in
used by the tests. Both feed the same parsing functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.functions.columns import joined_fields

TOPIC_SCHEMA = "offset BIGINT, key STRING, value STRING"

# The declared table of the reference's transaction topic.
TRANSACTIONS_DDL = "account_id BIGINT, amount BIGINT, transaction_time TIMESTAMP"
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def read_topic(spark: SparkSession, fmt: str = "kafka", *, servers: str | None = None,
               topic: str | None = None, path: str | None = None,
               max_per_trigger: int | str | None = None) -> DataFrame:
    """Streaming (offset, key, value) with key and value as UTF-8 strings.
    ``max_per_trigger`` bounds a micro-batch: offsets of a topic, bytes of files."""
    if fmt == "kafka":
        reader = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", servers)
                  .option("subscribe", topic))
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return reader.load().select(
            "offset", F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"))
    if fmt == "files":
        reader = spark.readStream.schema(TOPIC_SCHEMA)
        if max_per_trigger:
            reader = reader.option("maxBytesPerTrigger", max_per_trigger)
        return reader.parquet(path)
    raise ValueError("fmt must be 'kafka' or 'files'")


def parse_transactions(topic: DataFrame, watermark: str | None = "5 seconds",
                       lenient: bool = False) -> DataFrame:
    """S12 + T1: CSV values -> typed transactions, with the 5 s watermark
    (``transaction_time - INTERVAL '5' SECOND``). A malformed record fails the
    job, or is left out if ``lenient``; empty fields are nulls."""
    mode = {"timestampFormat": TS_FORMAT, "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": "_bad"}
    parsed = topic.select("value", F.from_csv(
        "value", f"{TRANSACTIONS_DDL}, _bad STRING", mode).alias("t"))
    wrong = F.col("t._bad").isNotNull() | F.col("value").isNull()
    if lenient:
        parsed = parsed.filter(~wrong)
    else:
        bad = F.raise_error(F.concat(F.lit("malformed record: "),
                                     F.coalesce("value", F.lit("null"))))
        parsed = parsed.withColumn("t", F.when(wrong, bad).otherwise(F.col("t")))
    parsed = parsed.select("t.*").drop("_bad")
    return parsed.withWatermark("transaction_time", watermark) if watermark else parsed


def render_topic(df: DataFrame, key_col: str, csv_cols: list[str],
                 offset_col: str | None = None) -> DataFrame:
    """Records as a topic would carry them: (offset,) key string, CSV value."""
    cols = [F.date_format(c, TS_FORMAT) if t.startswith("timestamp") else F.col(c).cast("string")
            for c, t in df.select(*csv_cols).dtypes]
    out = [F.col(key_col).cast("string").alias("key"), joined_fields(",", cols).alias("value")]
    if offset_col:
        out.insert(0, F.col(offset_col).cast("long").alias("offset"))
    return df.select(*out)
