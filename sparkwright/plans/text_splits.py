"""Inverted index of files of any size (Q10, S7): no file is one value.

Words are separated by single spaces only, so a newline is inside a word and a
word may reach over many lines. Files are read as lines, in splits; a line's inner
pieces are words by themselves, and its first and last pieces are stitched to
their neighbours': a line with a space ends the word that was open and opens the
next, so the number of such lines before a piece names its word. Those numbers are
running counts inside a split plus the totals of the file's earlier splits. One task
holds the edges (two pieces per line) of one split. Inner pieces are counted by split,
then by file, each in as many tasks as the files are read in, so what a task counts
doesn't grow with the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkwright.session import scratch_path
from sparkwright.sources.listing import list_files


def _lines(spark: SparkSession, path: str, name_from: str | None) -> DataFrame:
    """(name, path, split, line, size, value): ``line`` orders the lines of a split."""
    files = spark.read.option("lineSep", "\n").text(path)
    meta = F.col("_metadata")
    if name_from is None:
        name = meta["file_name"]
    else:  # an empty tree has no partition folders at all
        name = F.col(name_from).cast("string") if name_from in files.columns else F.lit(None).cast("string")
    return files.select(
        name.alias("name"),
        meta["file_path"].alias("path"), meta["file_block_start"].alias("split"),
        F.monotonically_increasing_id().alias("line"), meta["file_size"].alias("size"), "value")


def _edges(lines: DataFrame) -> DataFrame:
    """One row per line: its bytes, the first and (if there is another) last piece
    of its text without trailing spaces, and the number of these."""
    pieces = lines.withColumn("_rest", F.rtrim("value")).withColumn("_p", F.split("_rest", " ", -1))
    return pieces.select(
        "name", "path", "split", "line", "size", F.octet_length("value").alias("bytes"),
        F.col("_p")[0].alias("head"),
        F.when(F.size("_p") > 1, F.element_at("_p", -1)).alias("tail"),
        (F.length("value") - F.length("_rest")).alias("spaces"))


def _splits(edges: DataFrame) -> DataFrame:
    """One row per split of a file: its last line, whether the file ends in it and
    whether it ends with a newline. Fails for files that aren't plain text."""
    of_file, ahead = Window.partitionBy("path"), Window.partitionBy("path").orderBy("split")
    each = edges.groupBy("path", "split").agg(
        F.first("name").alias("name"), F.first("size").alias("size"), F.max("line").alias("last"),
        F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    ends = each.select(
        "*", (F.max("split").over(of_file) == F.col("split")).alias("final"),
        (F.sum("n").over(of_file) + F.sum("bytes").over(of_file) - F.col("size")).alias("_extra"),
        (F.sum("n").over(of_file) == 1).alias("single"), F.row_number().over(ahead).alias("_nth"))
    return ends.select(
        "path", "split", "name", "last", "final", "single",
        F.when(F.col("_extra") == 0, True).when(F.col("_extra") == 1, False).otherwise(
            F.raise_error(F.concat(F.lit("not a plain text file: "), "path"))).alias("newline"))


def inverted_index_splits(spark: SparkSession, path: str, name_from: str | None = None,
                          sort: bool = True) -> DataFrame:
    """(word, file, cnt) of the text files below ``path``: what ``inverted_index``
    gives for their whole contents, however large a file is.

    Files are named by base name or by the partition-folder column ``name_from``.
    They must be plain (uncompressed) text. A single word, with its newlines, must
    fit in one value. An empty file has one empty word, a file of spaces none.
    """
    lines = _lines(spark, path, name_from)
    kept = scratch_path(spark, "line-edges")
    _edges(lines).write.parquet(kept)
    edges = spark.read.parquet(kept)
    splits = _splits(edges)

    # Counted by split first, where the split's lines lie; a task holds the words of a few splits.
    tasks = max(1, lines.rdd.getNumPartitions())
    dealt = lines.select("name", F.xxhash64("path", "split").alias("_h"), "value").repartition(tasks, "_h")
    inner = dealt.select("name", "_h", F.split(F.rtrim("value"), " ", -1).alias("_p")).filter(
        F.size("_p") > 2).select("name", "_h", F.explode(F.slice("_p", 2, F.size("_p") - 2)).alias("word")).groupBy(
        "_h", "name", "word").agg(F.count(F.lit(1)).alias("cnt")).select("name", "word", "cnt")

    # A newline at the end of a file opens one more, empty, line.
    after = splits.filter("final AND newline").select(
        "name", "path", "split", (F.col("last") + 1).alias("line"), F.lit("").alias("head"),
        F.lit(None).cast("string").alias("tail"), F.lit(0).alias("spaces"), F.lit(False).alias("end"),
        F.lit(False).alias("blank"))
    found = edges.drop("name", "size", "bytes").join(splits, ["path", "split"]).withColumn(
        "end", F.col("final") & ~F.col("newline") & (F.col("line") == F.col("last")))
    # Trailing spaces count in all lines but the last of a file; alone they are no word at all.
    blank = F.col("end") & F.col("single") & (F.col("head") == "") & (F.col("spaces") > 0)
    rows = found.withColumn("blank", blank & F.col("tail").isNull()).select(after.columns).unionByName(
        after).withColumn("spaces", F.when(F.col("end"), 0).otherwise(F.col("spaces")))
    opens = (F.col("spaces") > 0) | F.col("tail").isNotNull()
    here = Window.partitionBy("path", "split").orderBy("line").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = rows.filter("NOT blank").withColumn("_opens", opens.cast("long")).withColumn(
        "_upto", F.sum("_opens").over(here))
    before = rows.groupBy("path", "split").agg(F.sum("_opens").alias("_n")).select(
        "path", "split", F.coalesce(F.sum("_n").over(Window.partitionBy("path").orderBy("split").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"))
    rows = rows.join(before, ["path", "split"]).withColumn("_upto", F.col("_upto") + F.col("_ahead"))

    first = F.struct((F.col("_upto") - F.col("_opens")).alias("w"), F.col("head").alias("piece"))
    last = F.struct(F.col("_upto").alias("w"), F.when(F.col("spaces") > 0, "").otherwise(
        F.col("tail")).alias("piece"))
    stitched = (rows.withColumn("_e", F.explode(F.when(F.col("_opens") == 1, F.array(first, last))
                                                .otherwise(F.array(first))))
                .groupBy("path", "_e.w").agg(
                    F.first("name").alias("name"),
                    F.sort_array(F.collect_list(F.struct("split", "line", "_e.piece"))).alias("_all"))
                .select("name", F.array_join("_all.piece", "\n").alias("word")))
    # Before a line's trailing spaces stands a whole word, between them empty ones.
    closed = rows.filter("spaces > 0").select("name", F.explode(F.concat(
        F.when(F.col("tail").isNotNull(), F.array("tail")).otherwise(F.array().cast("array<string>")),
        F.array_repeat(F.lit(""), F.col("spaces").cast("int") - 1))).alias("word"))
    # Spark's readers pass over empty files.
    base = F.element_at(F.split("path", "/"), -1)
    name = base if name_from is None else F.regexp_extract("path", f"/{name_from}=([^/]*)/", 1)
    empty = list_files(spark, path).filter((F.col("length") == 0) & ~base.rlike("^[._]")).select(
        name.alias("name"), F.lit("").alias("word"))
    others = stitched.unionByName(closed).unionByName(empty).withColumn("cnt", F.lit(1).cast("long"))
    counts = (inner.unionByName(others).withColumnRenamed("name", "file").repartition(tasks, "word", "file")
              .groupBy("word", "file").agg(F.sum("cnt").alias("cnt")))
    return counts.orderBy("word", "file") if sort else counts
