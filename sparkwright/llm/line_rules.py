"""Quality rules with cross-document line frequency.

Base rules look at one document. The line rule hashes each normalised line,
counts the distinct documents of a host that hold it, removes lines held by
more than ``max_docs`` of them, and rejects a document that is depleted: too
few words, or too small a part of its words, are left.

Every text is tokenised in one scan that writes a narrow table (counts, and key
and number of each line). Shuffles of those keys find the numbers of the lines
to remove. Texts are shuffled once, to meet them. All steps are built-in
expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwright.llm.common import SPACE, WORD, bind, materialise, n_words, null_key

MIN_WORDS = 50
#: A line in more documents of one host than this is removed.
MAX_DOCS = 10
#: A document is depleted below this part of its words.
MIN_LEFT = 0.5
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows found twice or more in the text.

    Windows are compared by 64-bit hash. Sorting (hash, position) puts equal
    windows side by side, so the work is n log n for the longest text.
    """
    windows = F.when(F.size(words) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(ordered: Column) -> Column:
        same = lambda x, k: F.coalesce(x["h"] == F.get(ordered, k)["h"], F.lit(False))
        hits = F.transform(ordered, lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["i"]))
        starts = F.filter(hits, lambda i: i.isNotNull())
        return F.size(F.array_distinct(F.flatten(F.transform(
            starts, lambda i: F.array(i, i + 1, i + 2)))))

    def count(w: Column) -> Column:
        ordered = F.sort_array(F.transform(
            w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) < F.size(w), bind(ordered, covered)).otherwise(0)

    return bind(windows, count)


def normalised_line(line: Column) -> Column:
    """Lower case, digit runs as 0, white-space runs as one space, trimmed."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(line), r"[0-9]+", "0"), SPACE, " ")
    return F.trim(plain)


def text_key(docs: DataFrame) -> list[Column]:
    """Never-null columns _id, _host, _hash: rows equal in them have the same
    lines and the same host, so the same lines removed."""
    return [null_key("doc_id").alias("_id"), null_key("source").alias("_host"),
            F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash")]


def document_counts(docs: DataFrame) -> DataFrame:
    """One row per document: its key, its base counts and ``lines``, an array of
    the lines that have a word, each as (key of host and normalised line, number
    of the line in the text from 0)."""

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"),
                        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                        repeated_words(w).cast("long").alias("n_repeat_words"))

    def of_lines(x: Column) -> Column:
        return F.struct(
            (F.size(x) - F.size(F.array_distinct(F.transform(x, lambda y: y["line"]))))
            .cast("long").alias("n_dup_lines"),
            F.transform(x, lambda y: F.struct(
                F.xxhash64(F.col("_host"), normalised_line(y["line"])).alias("key"),
                y["number"].alias("number"))).alias("lines"))

    text = F.col("_text")
    lines = F.filter(F.transform(F.split(text, "\n"), lambda y, i: F.struct(
        y.alias("line"), i.alias("number"))), lambda y: y["line"].rlike(WORD))
    return (docs.select(F.coalesce("text", F.lit("")).alias("_text"), *text_key(docs))
            .select(F.monotonically_increasing_id().alias("row_id"), "_id", "_host", "_hash",
                    (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")
                    .alias("n_symbols"),
                    bind(words_of(text), of_words).alias("_w"),
                    bind(lines, of_lines).alias("_l"))
            .select("row_id", "_id", "_host", "_hash", "_w.*", "n_symbols", "_l.*"))


def without_lines(text: Column, numbers: Column) -> Column:
    """``text`` without the lines of these numbers (from 0)."""
    def rest(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), numbers)
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    return F.when(F.size(numbers) > 0, bind(F.split(text, "\n"), rest)).otherwise(text)


def cleaned_documents(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """Per document: doc_id, source, text, removed_lines, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words.

    ``text`` is the text without its removed lines, which ``removed_lines``
    numbers (from 0, in order, lines as between newlines). The counts are those
    of the whole text. The host is ``source``; a null source is a host of its
    own. Every row is a document of its own, also when rows repeat or doc_id is
    null. A null text stays null and counts as empty. Columns besides doc_id,
    text and source are not read.
    """
    counts = materialise(document_counts(docs), "line-counts")
    keys = counts.select(F.explode(F.array_distinct(F.transform(
        "lines", lambda x: x["key"]))).alias("key"))
    frequent = materialise(
        keys.groupBy("key").count().filter(F.col("count") > max_docs).select("key"),
        "frequent-lines")
    lines = counts.select("row_id", F.explode("lines").alias("l")).select("row_id", "l.*")
    removed = (lines.join(frequent, "key").groupBy("row_id")
               .agg(F.sort_array(F.collect_list("number")).alias("removed_lines")))
    # Rows that repeat a key are equal here.
    found = (counts.drop("lines").join(removed, "row_id", "left").drop("row_id")
             .withColumn("removed_lines", F.coalesce("removed_lines", F.array().cast("array<int>")))
             .dropDuplicates(["_id", "_host", "_hash"]))
    # The narrow side is hashed, so texts aren't sorted for the join.
    joined = docs.select("doc_id", "source", "text", *text_key(docs)).join(
        found.hint("shuffle_hash"), ["_id", "_host", "_hash"])
    return joined.select(
        "doc_id", "source", without_lines(F.col("text"), F.col("removed_lines")).alias("text"),
        "removed_lines", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_rules(docs: DataFrame, min_words: int = MIN_WORDS, max_docs: int = MAX_DOCS,
                  min_left: float = MIN_LEFT) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, frequent_words.

    The verdict on what ``cleaned_documents`` leaves of each text: ``kept`` is
    judged by the words of the cleaned text, and ``frequent_words`` are those it
    has lost. A null text has 0 words, so it fails the base rules.
    """
    base_failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = (F.col("left") < min_words) | (F.col("left") < min_left * F.col("n_words"))
    return (cleaned_documents(docs, max_docs)
            .withColumn("left", n_words(F.col("text")))
            .withColumn("frequent_words", F.col("n_words") - F.col("left"))
            .withColumn("base_failed", base_failed)
            .withColumn("kept", ~base_failed & ~depleted)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed", "kept", "frequent_words"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, source FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (
  SELECT rid, i, list_slice(ws, i, i + 2) AS gram
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
gd AS (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, gram) > 1),
rw AS (
  SELECT rid, count(*) AS n FROM (
    SELECT DISTINCT rid, i + k AS pos FROM gd, (SELECT unnest([0, 1, 2]) AS k)) GROUP BY rid),
ln AS (
  SELECT rid, source, line FROM (SELECT rid, source, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dl AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM ln GROUP BY rid),
nl AS (
  SELECT rid, source, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
         trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
  FROM ln),
fr AS (
  SELECT source, norm FROM nl GROUP BY source, norm HAVING count(DISTINCT rid) > 10),
rm AS (
  SELECT nl.rid, sum(nl.words) AS n FROM nl JOIN fr
  ON nl.norm = fr.norm AND nl.source IS NOT DISTINCT FROM fr.source GROUP BY nl.rid),
b AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dl.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rw.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(rm.n, 0) AS BIGINT) AS frequent_words
  FROM d JOIN w USING (rid) LEFT JOIN dl USING (rid) LEFT JOIN rw USING (rid) LEFT JOIN rm USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND NOT (n_words - frequent_words < 50 OR 2 * (n_words - frequent_words) < n_words) AS kept,
       frequent_words
FROM b
"""
