"""Exact dedup by two passes over a Bloom filter.

Pass one hashes every row into a blocked Bloom filter (one 64-bit word per hash, a few
bits in it) and keeps the bits that were set more than once: a text that occurs twice has
set all its bits twice. Pass two tests every row against these bits. Rows that fail
cannot have a copy and pass straight through; only the rest shuffle, on their digest.

Defined cases: a null text counts as empty, all empty or blank texts are copies of each
other, an empty table gives an empty result, other columns are carried along by
``dedup`` whatever their names. Rows that tie in length and id are all marked as kept by
``classes``; ``dedup`` returns the one with the smallest text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import SPACE, only, stored, text_of

#: Bits of the filter for each row, and bits that a row sets in its word.
BITS_PER_ROW = 24
BITS_SET = 3
#: The repeated bits are broadcast up to this size, beyond it they are joined by shuffle.
MAX_BROADCAST_BYTES = 64 << 20


def digest(text_col: str = "text") -> Column:
    """sha256 of the text without white space."""
    return F.sha2(F.translate(text_of(text_col), SPACE, ""), 256)


def _bits(sha: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(sha, F.lit(i)), F.lit(64)).cast("int") for i in range(1, BITS_SET + 1)]


def _word(sha: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(sha), F.lit(words))


def repeated_bits(rows: DataFrame, words: int) -> DataFrame:
    """Pass one: ``_word`` and ``_twice``, the bits that more than one row has set."""
    sha = F.col("text_sha256")
    slots = rows.select(
        _word(sha, words).alias("_word"), F.explode(F.array_distinct(F.array(*_bits(sha)))).alias("_bit")
    )
    twice = slots.groupBy("_word", "_bit").agg(F.count("*").alias("_n")).filter("_n > 1")
    return twice.groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_twice"))


def marked(rows: DataFrame, twice: DataFrame, words: int) -> DataFrame:
    """Pass two: ``rows`` with ``_maybe``, true where all bits of the row are repeated."""
    sha = F.col("text_sha256")
    mask = F.lit(0).cast("bigint")
    for b in _bits(sha):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), b))
    held = F.coalesce(F.col("_twice").bitwiseAND(mask) == mask, F.lit(False))
    out = rows.withColumn("_word", _word(sha, words)).join(twice, "_word", "left")
    return out.withColumn("_maybe", held).drop("_word", "_twice")


def _filter(rows: DataFrame) -> tuple[DataFrame, int]:
    """The filter of ``rows`` (marked for broadcast if that is small enough), its words."""
    words = max(1, rows.count() * BITS_PER_ROW // 64)
    twice = stored(repeated_bits(rows, words), "bloom")
    return (F.broadcast(twice) if twice.count() * 16 <= MAX_BROADCAST_BYTES else twice), words


def _groups(maybe: DataFrame) -> DataFrame:
    best = F.min(F.struct((-F.col("_chars")).alias("c"), F.col("_id").alias("i")))
    return maybe.groupBy("text_sha256").agg(F.count("*").alias("group_size"), best.alias("_best"))


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return only(docs, id_col, text_col).select(
        F.col(id_col).alias("_id"), F.length(text_of(text_col)).alias("_chars"), digest(text_col).alias("text_sha256")
    )


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the one with the most code points stays, then the smallest id.
    """
    slim = stored(_slim(docs, id_col, text_col), "digests")
    twice, words = _filter(slim)
    rows = marked(slim, twice, words)
    maybe = rows.filter("_maybe")
    groups = _groups(maybe)
    # Written first, so that a join with a frequent digest can be split.
    copies = maybe.join(stored(groups, "groups"), "text_sha256").select(
        F.col("_id").alias("doc_id"),
        F.col("_best.i").alias("keep_id"),
        "group_size",
        (F.col("_id").eqNullSafe(F.col("_best.i")) & (-F.col("_chars") == F.col("_best.c"))).alias("kept"),
        "text_sha256",
    )
    alone = rows.filter("not _maybe").select(
        F.col("_id").alias("doc_id"),
        F.col("_id").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    return alone.unionByName(copies)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    slim = stored(_slim(docs, id_col, text_col), "digests")
    twice, words = _filter(slim)
    whole = docs.select(
        row.alias("_row"),
        F.col(f"`{id_col}`").alias("_id"),
        F.length(text_of(text_col)).alias("_chars"),
        digest(text_col).alias("text_sha256"),
    )
    rows = marked(whole, twice, words)
    maybe = rows.filter("_maybe")
    winner = F.col("_id").eqNullSafe(F.col("_best.i")) & (-F.col("_chars") == F.col("_best.c"))
    won = maybe.join(_groups(marked(slim, twice, words).filter("_maybe")), "text_sha256").filter(winner)
    kept = won.groupBy("text_sha256").agg(F.min_by("_row", text_of(f"_row.{text_col}")).alias("_row"))
    alone = rows.filter("not _maybe").select("_row")
    return alone.unionByName(kept.select("_row")).select("_row.*")
