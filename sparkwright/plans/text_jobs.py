"""Word count (Q9) and inverted index (Q10) over whole texts.

Both are narrow explode steps followed by one partial-aggregated group-by, so
a very common word costs one partial row per map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.functions.text import drop_final_empty, java_split_trimmed, trim_trailing
from sparkwright.operators.collect import PAGE, collect_lists
from sparkwright.session import scratch_path


def words_of_lines(lines: DataFrame, value_col: str = "value", *keep: str) -> DataFrame:
    """P10: one row per word, lines split on a single space (Java rules).

    The trimmed line is projected once, then split (two narrow steps in one
    stage), instead of recomputing it inside the generator.
    """
    trimmed = lines.select(*keep, F.col(value_col).alias("_v"),
                           trim_trailing(value_col, " ").alias("_t"))
    return trimmed.select(*keep, F.explode(java_split_trimmed("_v", "_t", " ")).alias("word"))


def lines_of_texts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """S6 on an in-table text column: one row per line (whole texts).

    The input is used as partitioned; a caller whose scan puts many texts in
    few partitions spreads it first (see ``documents``), because splitting
    is the CPU-heavy step.
    """
    parts = texts.select(F.split(text_col, "\n", -1).alias("_p"))
    return parts.select(F.explode(drop_final_empty("_p")).alias("value"))


def word_count(lines: DataFrame, value_col: str = "value",
               num_partitions: int | None = None) -> DataFrame:
    """Q9: (word, cnt) sorted by count descending, ties by word (O2).

    ``num_partitions`` mirrors ``reduceByKey(_ + _, n)``.
    """
    counts = (words_of_lines(lines, value_col)
              .groupBy("word").agg(F.count(F.lit(1)).alias("cnt")))
    if num_partitions:
        counts = counts.repartition(num_partitions, "word")
    return counts.orderBy(F.desc("cnt"), F.asc("word"))


def word_count_text_lines(counts: DataFrame) -> DataFrame:
    """K4 line format ``(word,n)`` in count order."""
    return counts.select(F.format_string("(%s,%d)", "word", "cnt").alias("value"))


def word_count_mapreduce(lines: DataFrame, reducers: int, value_col: str = "value") -> DataFrame:
    """Q9, MapReduce variant (K5): hash-partitioned into ``reducers`` files,
    each sorted by word, as ``word<TAB>count`` lines."""
    counts = (words_of_lines(lines, value_col)
              .groupBy("word").agg(F.count(F.lit(1)).alias("cnt")))
    return (counts.repartition(reducers, "word").sortWithinPartitions("word")
            .select(F.concat_ws("\t", "word", F.col("cnt").cast("string")).alias("value")))


def inverted_index(files: DataFrame, file_col: str = "file_name",
                   content_col: str = "content", sort: bool = True,
                   tasks: int | None = None) -> DataFrame:
    """Q10: (word, file, cnt), sorted by word then file unless not ``sort``.

    Whole file content is split on single spaces only (Java rules), so a
    newline stays inside a word, as in the reference. This long form is the
    scalable posting table: one row per (word, file).

    The input is used as partitioned: one file is one row, so spreading it
    cannot split a file's work, and a caller whose partitions each hold many
    rows (e.g. a table with few large row groups) spreads it first.

    With ``tasks`` the files themselves are dealt out by name to that many tasks
    and their words counted there, so no postings are shuffled to be counted. The
    sort has that many ranges; the postings are stored before it, as finding the
    ranges reads them once more. Give it for many files whose number grows with
    the input: a task then holds the postings of its files, however many there are.
    """
    src = files.select(F.col(file_col).alias("file"), F.col(content_col).alias("_c"))
    if tasks:
        src = src.repartition(tasks, "file")
    pairs = words_of_lines(src, "_c", "file")
    counts = pairs.groupBy("word", "file").agg(F.count(F.lit(1)).alias("cnt"))
    if not sort:
        return counts
    if tasks:
        spark = files.sparkSession
        kept = scratch_path(spark, "postings")
        counts.write.parquet(kept)
        return (spark.read.schema(counts.schema).parquet(kept)
                .repartitionByRange(tasks, "word", "file").sortWithinPartitions("word", "file"))
    return counts.orderBy("word", "file")


def posting_maps(index: DataFrame, page: int = PAGE) -> DataFrame:
    """A11 map form: (word, page, postings MAP<file, cnt>).

    A word's files, in the order of their names' hash, are cut into pages of at
    most ``page`` entries; the union of a word's maps is exact.
    """
    collected = collect_lists(index, "word", F.struct("file", "cnt"), "entries", page,
                              hash_by=F.col("entries.file"))
    return collected.select("word", "page", F.map_from_entries("entries").alias("postings"))
