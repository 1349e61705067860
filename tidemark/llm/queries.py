"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (alignment, bpe, exact_dedup, fingerprints, language_id, lm, merkle, mixing, near_dedup, packing, pii,
                          quality, substring_dedup)
from tidemark.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_bpe": bpe.op2_bpe,
    "op3_lm_scoring": lm.op3_lm_scoring,
    "op4_language_id": language_id.op4_language_id,
    "op5_fingerprints": fingerprints.op5_fingerprints,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_pii": pii.op7_pii,
    "op8_quality_classifier": quality.op8_quality_classifier,
    "op9_mixing": mixing.op9_mixing,
    "op10_simhash_near_dedup": near_dedup.op10_simhash_near_dedup,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_cross_tokenizer_alignment": alignment.op12_cross_tokenizer_alignment,
    "op13_packing": packing.op13_packing,
}

ORACLES: dict[str, str] = {
    "op1_substring_dedup": substring_dedup.OP1_SQL.strip(),
    "op6_exact_dedup": exact_dedup.OP6_SQL.strip(),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _shipped(fn) for name, fn in QUERIES.items()}


def oracles() -> dict[str, str]:
    return dict(ORACLES)


def _shipped(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run
