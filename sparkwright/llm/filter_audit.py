"""Audit of how filters interact, from relations of failing ids.

Every filter's failing rows are stored as one table of row numbers (with part
and labels). What a filter removes after a prefix of other filters is its own
table left-anti joined with the tables of the prefix; what of it is redundant
there is its own table left-semi joined with them. A prefix's effect doesn't
depend on its order, so 16 prefixes per filter serve all orders. Survivors come
the same way: rows that fail nothing by one left-anti join with all tables, the
others by left-anti joins with each prefix's.

The joins are shared: a row carries the prefix that it has survived so far and
leaves a second copy to be tested against the next table. One left-anti join per
stored table then serves every prefix that holds its filter, and one left-semi
join finds the rows that this filter of the prefix is the first to remove. Such
a row stays removed whatever follows, so it is counted once, under the prefix up
to that filter, and the count goes to all longer prefixes.

All joins are on the row number, which is unique, so neither a hot part nor a
large group of equal texts meets in a task. Parts and counts are aggregated
before any join on them.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkwright.llm.common import WORD, bind, materialise

FILTERS = "ABCDE"
# Fixed values of the filters.
LEAST_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 2
SYMBOLS = "[#$%&*|]"


def judged_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(row, doc_id, part, good, toxic, digest, fails): one row per document.

    ``fails`` holds the filters A to D that the text fails. ``good`` and
    ``toxic`` are 0 or 1 by any row of ``labels`` with the document's id; a null
    id has no labels. A null text counts as empty, a null source as ''.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("_text"))

    def failing(words):
        # Whole texts; the words of one text are held once.
        return F.filter(F.array(
            F.when(F.size(words) < LEAST_WORDS, "A"),
            F.when(100 * F.size(F.array_distinct(words)).cast("long")
                   < DISTINCT_PERCENT * F.size(words).cast("long"), "B"),
            F.when(100 * F.regexp_count("_text", F.lit("[A-Z]")).cast("long")
                   > CAPITAL_PERCENT * F.length("_text").cast("long"), "C"),
            F.when(F.col("_text").rlike(SYMBOLS), "D")), lambda x: x.isNotNull())
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "part",
        F.sha2("_text", 256).alias("digest"),
        bind(F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)), failing).alias("fails"))
    marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    return rows.join(marks, F.col("doc_id") == F.col("_id"), "left").select(
        "row", "doc_id", "part", F.coalesce("good", F.lit(0)).alias("good"),
        F.coalesce("toxic", F.lit(0)).alias("toxic"), "digest", "fails")


def failing_tables(rows: DataFrame) -> dict[str, DataFrame]:
    """One stored table (row, part, good, toxic) per filter.

    E fails where a smaller doc_id has the same text (by SHA-256), whether
    that row is removed or not. A null doc_id is neither smaller nor larger.
    """
    narrow = ["row", "part", "good", "toxic"]
    first = (rows.groupBy(F.col("digest").alias("_digest"))
             .agg(F.min("doc_id").alias("_least"), F.max("doc_id").alias("_most"))
             .filter("_most > _least"))
    later = rows.join(first, (F.col("digest") == F.col("_digest")) & (F.col("doc_id") > F.col("_least")))
    tables = {f: rows.filter(F.array_contains("fails", f)).select(narrow) for f in FILTERS[:-1]}
    tables["E"] = later.select(narrow)
    return {f: materialise(t, f"audit-fail-{f}") for f, t in tables.items()}


#: The filter of rows that are followed to count a prefix's survivors.
NONE = ""


def followed(tables: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(survivors, first_hits) of the failing rows, each (part, good, toxic,
    filter, prefix) with prefixes in A-E order.

    ``survivors``: the rows of ``filter``'s table that survive all filters of
    ``prefix``, for every prefix without ``filter``; with filter NONE all
    failing rows. ``first_hits``: those that survive ``prefix`` but for its
    last filter.
    """
    found = None
    for f, t in tables.items():
        found = t if found is None else found.unionByName(t)
    # By row number only: a row has one part and one pair of labels.
    failing = found.groupBy("row").agg(*[F.max(c).alias(c) for c in ("part", "good", "toxic")])
    found = failing.withColumns({"filter": F.lit(NONE), "prefix": F.lit("")})
    for f, t in tables.items():
        found = found.unionByName(t.withColumns({"filter": F.lit(f), "prefix": F.lit("")}))
    hits = None
    for f, t in tables.items():
        ids = t.select(F.col("row").alias("_row"))
        tested = found.filter(F.col("filter") != f).withColumn("prefix", F.concat("prefix", F.lit(f)))
        removed = tested.join(ids, F.col("row") == F.col("_row"), "left_semi")
        hits = removed if hits is None else hits.unionByName(removed)
        found = materialise(found.unionByName(
            tested.join(ids, F.col("row") == F.col("_row"), "left_anti")), "audit-survivors")
    return found.drop("row"), hits.drop("row")


def prefix_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(part, filter, prefix, removed, good_lost, toxic_lost, redundant) per
    filter and prefix without it; with filter NONE ``removed`` counts survivors
    among the rows that fail something. No row stands for zeros."""
    found, hits = followed(tables)
    alive = found.groupBy("part", "filter", "prefix").agg(
        F.count("*").alias("removed"), F.sum("good").alias("good_lost"),
        F.sum("toxic").alias("toxic_lost"), F.lit(0).cast("long").alias("redundant"))
    first = hits.filter(F.col("filter") != NONE).groupBy("part", "filter", "prefix").agg(
        F.count("*").alias("redundant"))
    # Each count goes on to the prefixes that go on from its own.
    further = F.lit([NONE])
    for f in FILTERS:
        more = F.transform(F.filter(further, lambda p: (F.lit(f) > F.substring(F.col("prefix"), -1, 1))
                                    & (F.lit(f) != F.col("filter"))), lambda p: F.concat(p, F.lit(f)))
        further = F.concat(further, more)
    gone = first.withColumn("prefix", F.explode(F.transform(further, lambda p: F.concat("prefix", p))))
    none = F.lit(0).cast("long")
    return (alive.unionByName(gone.select(
        "part", "filter", "prefix", none.alias("removed"), none.alias("good_lost"),
        none.alias("toxic_lost"), "redundant")).groupBy("part", "filter", "prefix")
        .agg(*[F.sum(c).alias(c) for c in ("removed", "good_lost", "toxic_lost", "redundant")]))


def with_every_step(parts: DataFrame) -> DataFrame:
    """``parts`` with (filter_order, step, filter, prefix, after) of all orders,
    600 rows per row: the filters ahead of the step's and up to it, in A-E order."""
    orders = ",".join("".join(o) for o in permutations(FILTERS))

    def first(n):
        letters = F.filter(F.split(F.substring("filter_order", F.lit(1), n), ""), lambda c: c != "")
        return F.array_join(F.array_sort(letters), "")
    return (parts.withColumn("filter_order", F.explode(F.split(F.lit(orders), ",")))
            .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
            .withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1)))
            .withColumn("prefix", first(F.col("step") - 1)).withColumn("after", first(F.col("step"))))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step: part, filter_order, step, kept,
    removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Repeated rows are documents of their own, each with the labels of its id.
    An empty table has no parts, hence no rows. Columns other than doc_id, text
    and source, and doc_id, quality and toxic, are not read.
    """
    rows = materialise(judged_rows(docs, labels), "audit-judged")
    tables = failing_tables(rows)
    parts = rows.select("part").distinct()
    clean = rows.select("row", "part")
    for t in tables.values():
        clean = clean.join(t.select("row"), "row", "left_anti")
    clean = clean.groupBy(F.col("part").alias("_part")).agg(F.count("*").alias("_clean"))
    totals = materialise(parts.join(clean, F.col("part") == F.col("_part"), "left").select(
        "part", F.coalesce("_clean", F.lit(0)).alias("_clean")), "audit-parts")

    counts = materialise(prefix_counts(tables), "audit-counts")
    # After all other filters a filter removes what only it fails.
    only = counts.filter((F.col("filter") != NONE) & (F.length("prefix") == len(FILTERS) - 1)).select(
        F.col("part").alias("_part"), F.col("filter").alias("_filter"),
        F.col("removed").alias("unique_fails"))
    alive = counts.filter(F.col("filter") == NONE).select(
        F.col("part").alias("_apart"), F.col("prefix").alias("_after"), F.col("removed").alias("_alive"))

    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    full = (with_every_step(totals).join(counts, ["part", "filter", "prefix"], "left")
            .join(only, (F.col("part") == F.col("_part")) & (F.col("filter") == F.col("_filter")), "left")
            .join(alive, (F.col("part") == F.col("_apart")) & (F.col("after") == F.col("_after")), "left"))
    return full.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        (F.col("_clean") + zero("_alive")).alias("kept"), zero("removed").alias("removed"),
        zero("redundant").alias("redundant"), zero("unique_fails").alias("unique_fails"),
        zero("good_lost").alias("good_lost"), zero("toxic_lost").alias("toxic_lost"),
        # 600 rows per part and filter meet in this window.
        F.sum(zero("removed")).over(Window.partitionBy("part", "filter")).alias("shapley"))


_FAILS_SQL = " UNION ALL ".join(f"SELECT row, part, good, toxic, '{f}' AS f FROM j WHERE fail_{f}"
                                for f in FILTERS)
ORACLE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS w
  FROM documents),
m AS (
  SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic
  FROM labels GROUP BY doc_id),
j AS MATERIALIZED (
  SELECT row, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         len(w) < {LEAST_WORDS} AS fail_A,
         100 * len(list_distinct(w)) < {DISTINCT_PERCENT} * len(w) AS fail_B,
         100 * len(regexp_extract_all(t, '[A-Z]')) > {CAPITAL_PERCENT} * length(t) AS fail_C,
         regexp_matches(t, '{SYMBOLS}') AS fail_D,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS fail_E
  FROM d LEFT JOIN m USING (doc_id)),
x AS MATERIALIZED ({_FAILS_SQL}),
o AS (
  SELECT a || b || c || d || e AS filter_order
  FROM (SELECT unnest(['A','B','C','D','E']) AS a), (SELECT unnest(['A','B','C','D','E']) AS b),
       (SELECT unnest(['A','B','C','D','E']) AS c), (SELECT unnest(['A','B','C','D','E']) AS d),
       (SELECT unnest(['A','B','C','D','E']) AS e)
  WHERE len(list_distinct([a, b, c, d, e])) = 5),
s AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS f,
         list_sort(string_split(substr(filter_order, 1, step - 1), '')) AS prefix
  FROM o, (SELECT unnest(range(1, 6)) AS step)),
p AS MATERIALIZED (SELECT DISTINCT f, prefix FROM s),
all_fails AS MATERIALIZED (SELECT row, list(f) AS fs FROM x GROUP BY row),
c AS (
  SELECT x.part, p.f, p.prefix, count(*) AS failing,
         count(*) FILTER (NOT list_has_any(fs, prefix)) AS removed,
         count(*) FILTER (NOT list_has_any(fs, prefix) AND good = 1) AS good_lost,
         count(*) FILTER (NOT list_has_any(fs, prefix) AND toxic = 1) AS toxic_lost,
         count(*) FILTER (len(fs) = 1) AS unique_fails
  FROM x JOIN all_fails USING (row) JOIN p ON p.f = x.f GROUP BY ALL),
g AS (
  SELECT n.part, n.n, s.*, coalesce(removed, 0) AS removed, coalesce(failing, 0) AS failing,
         coalesce(good_lost, 0) AS good_lost, coalesce(toxic_lost, 0) AS toxic_lost,
         coalesce(unique_fails, 0) AS unique_fails
  FROM (SELECT part, count(*) AS n FROM j GROUP BY part) n CROSS JOIN s
  LEFT JOIN c ON c.part = n.part AND c.f = s.f AND c.prefix = s.prefix)
SELECT part, filter_order, step,
  CAST(n - sum(removed) OVER (PARTITION BY part, filter_order ORDER BY step) AS BIGINT) AS kept,
  removed, failing - removed AS redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM g
"""
