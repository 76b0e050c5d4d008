"""The corpus pipeline: quality rules, near duplicates, benchmark passages,
secrets, packing.

Each stage takes (spark, docs, sf_dir); ``run`` starts from the table
``documents`` and writes each stage's rows before the next one reads them.  All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlink.llm.common import stage, table
from eventlink.llm.host_quality import keep_quality
from eventlink.llm.packing import pack, packed_digest
from eventlink.llm.secret_scan import redact
from eventlink.llm.simhash import keep_first
from eventlink.llm.winnow import drop_contaminated


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule, or whose host fails, go."""
    return keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the document with the smallest id stays."""
    return keep_first(docs, width=4, distance=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more lies in benchmark windows go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, with their secrets replaced."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4,096 ids."""
    return packed_digest(pack(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("packing", packing),
]

#: Fingerprints, trained models and differencing are beyond SQL; the tests hold
#: every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
