"""The queries of this subpackage: thin, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat_format, cross_tokens, decontamination, exact_dedup, hyperminhash, line_dedup, mixing, periodic_runs, pitman_yor, sharding, token_records, toxicity, word_bpe
from .common import table


def over(*names_and_function) -> Callable[[SparkSession, str], DataFrame]:
    *names, f = names_and_function
    return lambda spark, sf_dir: f(*(table(spark, sf_dir, n) for n in names))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_records": over("documents", token_records.op1_token_records),
    "op2_toxicity": over("documents", "labels", toxicity.op2_toxicity),
    "op3_lm_scoring": over("documents", pitman_yor.op3_lm_scoring),
    "op4_chat_format": over("conversations", chat_format.op4_chat_format),
    "op5_exact_dedup": over("documents", exact_dedup.op5_exact_dedup),
    "op10_minhash_near_dedup": over("documents", hyperminhash.op10_minhash_near_dedup),
    "op6_line_dedup": over("documents", line_dedup.op6_line_dedup),
    "op7_bpe_codec": over("documents", word_bpe.op7_bpe_codec),
    "op8_sharding": over("documents", sharding.op8_sharding),
    "op9_decontamination": over("documents", "benchmark", decontamination.op9_decontamination),
    "op11_cross_tokens": over("documents", cross_tokens.op11_cross_tokens),
    "op12_source_mixing": over("documents", mixing.op12_source_mixing),
    "op13_periodic_runs": over("documents", periodic_runs.op13_periodic_runs),
}

ORACLE_SQL: dict[str, str] = {"op5_exact_dedup": exact_dedup.OP5_SQL, "op6_line_dedup": line_dedup.OP6_SQL, "op10_minhash_near_dedup": hyperminhash.OP10_SQL, "op12_source_mixing": mixing.OP12_SQL}
