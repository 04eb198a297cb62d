"""Queries of the two substring dedups: 2 and 3."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import phrase_dedup, suffix_dedup
from tickloom.llm.common import table
from tickloom.llm.native import query


@query()
def op2_merged_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 200-byte strings that occur elsewhere."""
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


@query()
def op3_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 50-word windows that start in an earlier one."""
    return phrase_dedup.digests(table(spark, sf_dir, "documents"))
