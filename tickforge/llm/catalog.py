"""Registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickforge.llm import (alignment, bpe, context_tree, cross_polytope, divergence, exact_dedup, jaccard_join, lang_id, mixing, quality,
                           sharding, syncmers, unit_dedup)
from tickforge.session import configure

MODULES = {
    "op1_site_quality": quality,
    "op2_language_id": lang_id,
    "op3_parity_jaccard": jaccard_join,
    "op4_context_tree": context_tree,
    "op5_unit_dedup": unit_dedup,
    "op6_closed_syncmers": syncmers,
    "op7_pareto_mixing": mixing,
    "op8_exact_dedup": exact_dedup,
    "op9_bpe_automaton": bpe,
    "op10_sampled_splitters": sharding,
    "op11_alignment_audit": alignment,
    "op12_cross_polytope": cross_polytope,
    "op13_source_divergence": divergence,
}


#: Bytes of an Arrow batch: Python workers hold a few batches of whole texts at a time.
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession, batch_bytes: int = BATCH_BYTES) -> None:
    """Session settings that the operators rely on."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))


def _configured(fn: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _configured(m.query) for name, m in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: m.ORACLE_SQL for name, m in MODULES.items() if m.ORACLE_SQL}
