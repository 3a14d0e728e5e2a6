"""Corpus pipeline: documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet and reads again as the next stage's ``docs``.  All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievery.llm import linededup, neardup, packing, quality, secretscan
from sievery.llm.common import materialize, read_table


def _recounted(before: DataFrame, after: DataFrame) -> DataFrame:
    """``after`` in the columns of ``before``, with ``n_chars`` of the new text."""
    n = F.coalesce(F.char_length("text"), F.lit(0)).cast("long")
    return after.select(*[n.alias(c) if c == "n_chars" else F.col(c) for c in before.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go; the others stay as they were."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document with a smaller id holds go from the text."""
    return _recounted(docs, linededup.dedup_lines(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return neardup.keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the text give way to a mask; every document stays."""
    return _recounted(docs, secretscan.redact(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, cut into pieces and packed into sequences."""
    return packing.pack(docs)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("secret_scans", secret_scans), ("packing", packed)]

# Similarity classes, entropy and token ids are beyond SQL; tests/llm has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return last(spark, docs, sf_dir)
