"""The corpus pipeline: five stages over ``documents``, each one call of an
operator of ``sparkwright.llm``.

A stage gets what its predecessor kept and returns the columns of
``documents``; the last returns tokens. ``run`` writes every stage's result to
the shared scratch folder and reads it again, so a lost executor costs at most
one stage's tasks and lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.llm import merge_dropout, mixing, simhash, substring_dedup, toxicity
from sparkwright.llm.common import (SPACE, drop_scratch, fresh, materialise, scratch_mark,
                                    scratch_since)
from sparkwright.session import apply_defaults
from sparkwright.sources.files import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't predict toxic."""
    apply_defaults(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates (4-word shingles,
    at most 4 bits)."""
    apply_defaults(spark)
    return simhash.keep_one_per_group(docs, shingle=4, max_bits=4)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines and sentences that an earlier one has.

    ``n_chars``, where the table has it, follows the new text. A document of
    which nothing but white space is left goes; one that was empty stays.
    """
    apply_defaults(spark)
    spans = fresh(docs, "removed_spans")
    cut = substring_dedup.substring_dedup(docs)
    blank = F.regexp_replace("text", SPACE, "") == ""
    out = cut.filter((F.size(spans) == 0) | ~blank)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast(kind))
                             .otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the capped mix takes them."""
    apply_defaults(spark)
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, tokens, lossless per document of the mix."""
    apply_defaults(spark)
    return merge_dropout.encode_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("merge_dropout", encode),
]

#: Near-duplicate components, a trained classifier and merge-dropout have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last."""
    apply_defaults(spark)
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        mark = scratch_mark()
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        # Only this stage's result is read from here on.
        *own, written = scratch_since(mark)
        drop_scratch(spark, [p for p in [*before, *own] if p])
        before = [written]
    return docs
