"""A corpus pipeline of the text operators: filter, dedupe, decontaminate, pack.

``run`` writes each stage's documents as Parquet below the shared folder and reads them
back for the next one, so a lost executor costs at most one stage's tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import decontamination, exact_dedup, near_copies, packing, toxicity
from tickloom.llm.common import stored, table
from tickloom.session import configure

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxicity threshold."""
    return toxicity.clean(docs, table(configure(spark), sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that differs in white space at most."""
    configure(spark)
    return exact_dedup.dedup(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by similarities of 0.8 or more in 5-word shingles, found
    by vantage-point trees over SimHash fingerprints and confirmed by the shingles."""
    configure(spark)
    return near_copies.dedup(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no test item leaked into."""
    return decontamination.clean(docs, table(configure(spark), sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents in training sequences."""
    import public_tokenizers

    configure(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: SQL expresses neither the Viterbi search nor alignment; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
