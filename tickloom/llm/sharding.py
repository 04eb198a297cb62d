"""Shards that all have the mixture of the whole: proportional stratified interleaving.

Rows of each source are put in a seeded random order; the row of rank r among n has the
fractional rank (2r - 1) / 2n. Sorting all rows by it interleaves the sources in
proportion, and cutting the order into equal parts gives shards whose row counts differ
by at most one and whose sources have their share up to one row each.

Both orders are made by counting buckets first (``common.ranked``), so neither a large
source nor the whole table is sorted in one task, and only ids, sizes and checksums
shuffle, never texts.

Defined cases: a null text has size 1, a null source counts as the source '', an empty
table gives an empty result. Rows repeated as a whole are interchangeable. Copies of a
text are not kept together: the law is ``rows``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import only, ranked, text_of

#: Hex digits of md5 that order the rows of a source.
DIGITS = 15


def interleave(
    docs: DataFrame,
    shards: int = 16,
    seed: int = 42,
    rows_per_bucket: int = 20_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """doc_id, source, size, text_crc32, shard, slot for every row of ``docs``."""
    n = docs.count()
    buckets = max(1, n // rows_per_bucket)
    size, crc = (F.octet_length(text_of(f"`{text_col}`")) + 1).cast("bigint"), F.crc32(text_of(f"`{text_col}`"))
    # Rows without an id draw by their texts, so that they don't all fall into one bucket.
    who = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.concat_ws(":", size.cast("string"), crc.cast("string")))
    drawn = F.substring(F.md5(F.concat_ws(":", F.lit(seed), who)), 1, DIGITS)
    slim = only(docs, *dict.fromkeys([id_col, source_col, text_col])).select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{source_col}`"), F.lit("")).alias("source"),
        size.alias("size"),
        crc.alias("text_crc32"),
        F.conv(drawn, 16, 10).cast("bigint").alias("_u"),
    )
    by_draw = (F.col("_u") / F.lit(float(16**DIGITS)) * buckets).cast("bigint")
    in_source = ranked(slim, ["source"], by_draw, ["_u", "doc_id", "size", "text_crc32"])
    spread = in_source.withColumn("_f", (2 * F.col("rank") - 1) / (2 * F.col("total"))).drop("rank", "total")
    placed = ranked(spread, [], (F.col("_f") * buckets).cast("bigint"), ["_f", "source", "_u", "doc_id"])
    at = F.col("rank") - 1
    cut = placed.withColumn("shard", F.expr(f"(rank - 1) * {shards}L div {max(1, n)}L"))
    first = F.expr(f"(shard * {n}L + {shards - 1}L) div {shards}L")
    return cut.select(
        "doc_id", "source", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), (at - first).alias("slot")
    )
