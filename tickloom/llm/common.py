"""What the text operators share: table access, word bytes, ranks without one big window."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.session import stored

__all__ = ["SPACE", "WORD", "Filter", "arrow_rows", "bit_filter", "fresh", "only", "ranked", "stored", "table", "text_of"]

#: The white space of all contracts, as characters and as a pattern of words in bytes.
SPACE = " \t\n\x0b\x0c\r"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Bits of a filter for each entry, and in all (64 MB).
BITS_PER_ENTRY, MAX_BITS = 16, 1 << 29


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, *names: str) -> DataFrame:
    """Just the named columns, so that no other column can clash with an operator's own."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def fresh(df: DataFrame, name: str) -> str:
    """``name``, longer if a column of ``df`` has it."""
    while name in df.columns:
        name += "_"
    return name


def text_of(column: str = "text") -> Column:
    """The text, a null counting as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def arrow_rows(
    df: DataFrame,
    per_row: Callable[..., Iterable[tuple]],
    schema: StructType | str,
    finish: Callable[[], Iterable[tuple]] | None = None,
    setup: Callable[[], tuple] | None = None,
    flush: int = 20_000,
) -> DataFrame:
    """``per_row(*state, *row)`` gives output rows for each input row, in Arrow batches.

    ``setup`` makes the state once in each task; ``finish(*state)`` gives the task's last
    rows. At most ``flush`` output rows are held.
    """
    schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        state = setup() if setup else ()

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, arrow.types, strict=True)], schema=arrow
            )

        held: list[tuple] = []
        for b in batches:
            columns = b.columns
            for i in range(b.num_rows):
                held.extend(per_row(*state, *[c[i].as_py() for c in columns]))
                if len(held) >= flush:
                    yield batch(held)
                    held = []
        if finish:
            for row in finish(*state):
                held.append(row)
                if len(held) >= flush:
                    yield batch(held)
                    held = []
        if held:
            yield batch(held)

    return df.mapInArrow(run, schema)


def ranked(df: DataFrame, key: list[str], bucket: Column, order: list[str]) -> DataFrame:
    """``df`` with ``rank`` (from 1) and ``total`` of its rows within ``key``.

    ``bucket`` must not fall as ``order`` rises. Rows are only sorted within a (key,
    bucket); what lies before a bucket comes from an aggregate with one row per bucket, so
    no task sorts a whole key. Key columns must not be null.
    """
    df = df.withColumn("_bucket", bucket)
    counts = df.groupBy(*key, "_bucket").agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(*key) if key else Window.partitionBy(F.lit(0))
    before = counts.select(
        *key,
        "_bucket",
        (F.sum("_n").over(whole.orderBy("_bucket")) - F.col("_n")).alias("_before"),
        F.sum("_n").over(whole).alias("total"),
    )
    inside = Window.partitionBy(*key, "_bucket").orderBy(*order)
    joined = df.join(before, [*key, "_bucket"])
    return joined.withColumn("rank", F.col("_before") + F.row_number().over(inside)).drop("_bucket", "_before")


def within(df: DataFrame, row_bytes: int, limit: int = 64 << 20) -> DataFrame:
    """A stored ``df`` marked for broadcast if its rows take at most ``limit`` bytes, else
    as it is, to be joined by shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


class Filter:
    """A bit for the hash of each entry; the bits are a power of two. What is not in it is no
    entry, what is in it may be one."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.last = bits, len(bits) * 64 - 1

    def __contains__(self, number: int) -> bool:
        at = number & self.last
        return bool(int(self.bits[at >> 6]) >> (at & 63) & 1)

    def hold(self, numbers: np.ndarray) -> np.ndarray:
        at = numbers & np.uint64(self.last)
        return (self.bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def bit_filter(numbers: DataFrame, count: int, max_bits: int = MAX_BITS) -> Filter:
    """A filter of the one column of longs: bits are set per slot of 64 by Spark, and at
    most ``max_bits`` / 64 slots reach the driver."""
    size = 64
    while size < min(max_bits, BITS_PER_ENTRY * count):
        size *= 2
    number = F.col(numbers.columns[0])
    bit = number.bitwiseAND(63).cast("int")
    slot = F.shiftright(number.bitwiseAND(size - 1), 6)
    slots = numbers.groupBy(slot.alias("slot")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits"))
    got = slots.toArrow()
    bits = np.zeros(size // 64, dtype=np.uint64)
    bits[got.column("slot").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return Filter(bits)


def without(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id", limit: int = 64 << 20) -> DataFrame:
    """``docs`` without the rows whose id is in ``dropped`` (one id column, no repeats).

    Ids of up to ``limit`` bytes are broadcast. Beyond that their bits are, 64 MB at most:
    rows that fail the bits pass straight through, and only the rest shuffle with their texts.
    """
    key = fresh(docs, "_gone")
    gone = stored(dropped.select(F.col(dropped.columns[0]).alias(key)), "dropped")
    count = gone.count()
    same = F.col(f"`{id_col}`") == F.col(key)
    if count * 16 <= limit:
        return docs.join(F.broadcast(gone), same, "left_anti")
    bits = docs.sparkSession.sparkContext.broadcast(bit_filter(gone.select(F.xxhash64(key)), count))

    @F.pandas_udf("boolean")
    def listed(number: pd.Series) -> pd.Series:
        return pd.Series(bits.value.hold(number.to_numpy().view(np.uint64)))

    # The types must agree for the hashes to do so.
    maybe = listed(F.xxhash64(F.col(f"`{id_col}`").cast(gone.schema[0].dataType)))
    return docs.filter(~maybe).unionByName(docs.filter(maybe).join(gone, same, "left_anti"))
