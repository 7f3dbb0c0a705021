"""The corpus pipeline: quality classifier, near-duplicate removal, substring
removal, secret redaction, packing.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as parquet and
reread as the next one's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import nb_svm, packing, repeats, secrets, simhash
from ledgerline.llm.staging import documents, staged

STAGES = [
    ("quality_classifier", nb_svm.keep_good),
    ("simhash_dedup", simhash.keep_one),
    ("substring_dedup", repeats.remove_stage),
    ("secret_scan", secrets.redact_stage),
    ("best_fit_packing", packing.pack_documents),
]

# a fitted classifier and a tokenizer are among the stages: SQL cannot express run()
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that all stages leave."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
