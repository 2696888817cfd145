"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing.

Every stage works on all documents that the one before it kept; between two stages the
documents are written as Parquet to the shared folder and read again, so that a lost
executor costs no more than tasks of the running stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from funnelloom.llm import decontaminate, line_templates, packing, rule_ledger, simhash
from funnelloom.llm.common import stored, table
from funnelloom.llm.tokens import public_tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the current policy go."""
    return rule_ledger.judged(docs, rule_ledger.CURRENT)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go; their documents stay."""
    return line_templates.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays."""
    return simhash.deduplicated(docs, size=4, radius=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 ids."""
    return packing.pack(docs, public_tokenizer("word_bpe_49k.json"), size=2048, end_id=1)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", sequence_packing),
]

# Fingerprints, windows and packing are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
