"""The corpus pipeline: toxicity, line dedup, near-duplicate join, substring dedup, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept; all but the
last return the columns of documents.  A document without visible text after a dedup stage goes;
of each component of near copies the smallest id stays.  The last stage returns one row for each
packed piece.  SQL cannot express the classifier or the tokenizer, so there is no ORACLE_SQL; the
tests hold the stages against plain-Python versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from medgraph.llm import jaccard, lines, packing, substrings, toxicity
from medgraph.llm.common import materialize, small_batches, table

ORACLE_SQL = None

#: Bytes of text that packing takes at once here: executors still hold memory of earlier stages.
PACKING_SLICE = 1 << 20


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents scored 0.5 or more go."""
    small_batches(spark)
    return toxicity.keep_ordinary(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: repeated multi-line chunks go, but for the first."""
    small_batches(spark)
    return lines.strip_repeats(docs)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: one document of each component stays."""
    small_batches(spark)
    return jaccard.keep_one(docs)


def dedup_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: words of windows that an earlier document holds go."""
    small_batches(spark)
    return substrings.strip_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: what is left, packed."""
    small_batches(spark)
    return packing.pack_documents(docs, slice_bytes=PACKING_SLICE)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", join_near_copies),
    ("substring_dedup", dedup_substrings),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
