"""The corpus pipeline: quality rules, exact dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet in the shared folder and read again as the next stage's documents. All
stages but the last return the columns of ``documents``. Null texts, identifiers,
languages and sources are handled as the operators say; empty tables pass
through; further columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rillet.llm.common import tables, written
from rillet.llm.exact_dedup import dedup_exact
from rillet.llm.minhash import dedup_near
from rillet.llm.mixing import mix
from rillet.llm.packing import pack_documents
from rillet.llm.quality_rules import keep_good


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor a certified cutoff of their language rejects."""
    return keep_good(docs, tables(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the row with the largest doc_id."""
    return dedup_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the smallest doc_id."""
    return dedup_near(docs, width=5)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target shares: documents cut, left out or repeated by blocks of words."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their length bucket, batch and slot."""
    return pack_documents(docs)


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("mixing", mixing), ("packing", packing)]

#: No SQL: the risk-controlled cutoffs, the components and the draws are beyond it; tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = tables(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
