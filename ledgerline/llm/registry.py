"""Queries of the training-data operators and, where SQL can say it, their
DuckDB SQL. Names: ``opN_<name>`` and ``pipeline``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import oracle_sql as sql
from ledgerline.llm.ballkmeans import op13_ball_kmeans
from ledgerline.llm.bpe import op5_bpe
from ledgerline.llm.kronecker import op12_kronecker
from ledgerline.llm.line_frequency import op1_line_frequency
from ledgerline.llm.maxent import op4_maxent
from ledgerline.llm.minhash import op11_minhash
from ledgerline.llm.nb_svm import op2_nb_svm
from ledgerline.llm.packing import op8_best_fit
from ledgerline.llm.pii import op7_boosted
from ledgerline.llm.repeats import op10_substring_dedup
from ledgerline.llm.secrets import op6_ownership
from ledgerline.llm.simhash import op3_simhash
from ledgerline.llm.topk import op9_top_k

Query = Callable[[SparkSession, str], DataFrame]


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline`` over the whole ``documents`` table."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_line_frequency, op2_nb_svm, op3_simhash, op4_maxent, op5_bpe, op6_ownership, op7_boosted, op8_best_fit,
        op9_top_k, op10_substring_dedup, op11_minhash, op12_kronecker, op13_ball_kmeans, pipeline)}


def oracle_sql() -> dict[str, str]:
    """The other queries need trained models, XXH64, a tokenizer or look-behind
    patterns; ``tests/llm`` holds them against brute force."""
    return {"op1_line_frequency": sql.LINE_FREQUENCY, "op9_top_k": sql.TOP_K, "op10_substring_dedup": sql.SUBSTRING,
            "op11_minhash": sql.NEAR_DUPLICATES, "op12_kronecker": sql.HARD_NEGATIVES, "op13_ball_kmeans": sql.VECTOR_CODES}
