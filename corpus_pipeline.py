"""From raw documents to packed sequences: each stage works on all that the one before kept.

Stages take (spark, docs, sf_dir) and return a DataFrame. Between stages rows
are written as Parquet to the shared folder and read again, so a lost executor
costs no earlier stage. All but the last return the columns of documents.

Nulls and clashing names: every stage keeps unknown columns as they are. A
null text is `und` and goes with the first stage; rows that repeat a doc_id, or
have none, are each a document of their own. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leavewatch.llm import decontamination, jaccard_join, language_id, line_dedup, packing
from leavewatch.llm.tables import each_row, table
from leavewatch.sources.shared_storage import cut_lineage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without a letter, or of several languages without a main one, go."""
    return language_id.identified(docs)


def repeated_lines_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without line chunks that stood in an earlier document; documents left without text go."""
    return each_row(docs, line_dedup.cleaned)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first by doc_id, of each group of near duplicates."""
    return each_row(docs, jaccard_join.one_of_each_group)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with a benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and offset."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", repeated_lines_removed),
    ("jaccard_join", one_of_near_duplicates),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

ORACLE_SQL = None  # tokens, EM and hashes are not SQL; tested against a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
