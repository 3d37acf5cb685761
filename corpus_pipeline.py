"""The corpus pipeline: five stages over `documents`, each written and read again as the next one's input.

Toxic documents go, then exact copies, near copies and documents with benchmark passages; what is
left is encoded. A stage works on all that its predecessor kept and sees nothing else of the corpus.

Defined cases, of every stage: a null text is empty; rows without a doc_id are never dropped by a copy or a passage, and
are scored and encoded like others; rows that repeat a doc_id are told apart by their texts, so that no text is lost;
very long texts are taken whole; a stage of an empty table gives an empty one; other columns are kept up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from prospectra.llm.common import materialize, table
from prospectra.llm.decontamination import decontaminate
from prospectra.llm.exact_dedup import exact_dedup
from prospectra.llm.hyperminhash import near_dedup
from prospectra.llm.toxicity import drop_toxic
from prospectra.llm.word_bpe import default_vocabulary, encoded


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2, fitted on the labelled documents among docs: those that it predicts toxic go. Without labels of both classes nothing tells documents apart, and all stay unless all labels say toxic."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of equal texts the row with the largest doc_id stays, one row even if that doc_id repeats."""
    return exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of each component one row with the smallest doc_id stays; texts without words are in none and stay."""
    return near_dedup(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: rows with a passage of a test item go; without items all stay."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: doc_id, ids and decoded text of every row that is left."""
    return encoded(docs, default_vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("decontamination", benchmark_passages),
    ("bpe", token_ids),
]

#: A fitted classifier and the vocabulary's merges are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
