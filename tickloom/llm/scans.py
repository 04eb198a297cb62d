"""Queries of the operators that score or search texts in Python tasks: 1, 6, 9, 10."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import decontamination, disclosure, simhash, toxicity
from tickloom.llm.common import table
from tickloom.llm.native import query


@query()
def op1_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its toxicity score."""
    scored = toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "n_words",
        "n_restored",
    )


@query()
def op6_simhash_vantage_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and its group of near copies."""
    return simhash.groups(table(spark, sf_dir, "documents"))


def _written(spans: Column) -> Column:
    """Spans as kind:start:end by start, then kind."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query()
def op9_information_theoretic_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data and the terms that give them away."""
    found = disclosure.sanitised(table(spark, sf_dir, "documents"))
    rank = {k: i for i, k in enumerate((*disclosure.KINDS, "term"))}
    order = F.create_map(*[F.lit(x) for kv in rank.items() for x in kv])
    keyed = F.transform(
        F.concat("base", "terms"),
        lambda s: F.struct(s["start"].alias("start"), F.element_at(order, s["kind"]).alias("k"), s["kind"].alias("kind"), s["end"].alias("end")),
    )
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size("base") - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{k}") for k in disclosure.KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.array_sort(keyed)).alias("spans"),
        F.size("terms").cast("bigint").alias("n_term"),
    )


@query()
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the test item that contaminates it, if any."""
    return decontamination.judged(
        decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    )
