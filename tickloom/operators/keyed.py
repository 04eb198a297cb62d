"""Keyed tables: dedupe, insert if absent, upsert, retention, latest rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order``.

    An aggregate, not a window: copies of a key are reduced in every map task, so a key
    that makes up a third of the data costs no more than any other.
    """
    return _keep(df, keys, order, F.min_by)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last in ``order``."""
    return _keep(df, keys, order, F.max_by)


def _keep(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    row = pick(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*[c if c in keys else F.col(f"_row.{c}") for c in df.columns])


def insert_if_absent(
    incoming: DataFrame, existing: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Incoming rows whose key is new, one per key. Replays give nothing."""
    return keep_first(incoming, keys, order).join(existing.select(*keys), list(keys), "left_anti")


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The table after a bulk put: the row with the highest version wins per key."""
    return keep_last(existing.unionByName(incoming), keys, version)


def live(df: DataFrame, as_of_us: int | Column, ttl: str = "ttl") -> DataFrame:
    """Rows that are not expired at ``as_of_us``."""
    at = F.lit(as_of_us) if isinstance(as_of_us, int) else as_of_us
    return df.filter(F.col(ttl) >= F.floor(at / 1_000_000))


def between(df: DataFrame, start_us: int | None = None, end_us: int | None = None) -> DataFrame:
    """Rows with start <= ts_us <= end; either side may be open."""
    if start_us is not None and end_us is not None and start_us > end_us:
        raise ValueError("start must not be after end")
    if start_us is not None:
        df = df.filter(F.col("ts_us") >= start_us)
    if end_us is not None:
        df = df.filter(F.col("ts_us") <= end_us)
    return df


def look_back(
    df: DataFrame, hours: int, as_of_us: int, *, inclusive: bool = True, max_hours: int | None = None
) -> DataFrame:
    """Rows of the last ``hours`` hours before ``as_of_us``; more than ``max_hours`` is an error."""
    if max_hours is not None and hours > max_hours:
        raise ValueError(f"hours must be at most {max_hours}")
    cutoff = as_of_us - hours * 3_600_000_000
    c = F.col("ts_us")
    return df.filter((c >= cutoff) if inclusive else (c > cutoff))


def latest_n(
    df: DataFrame,
    n: int,
    order: Sequence[str] = ("ts_us", "seq"),
    by: Sequence[str] = ("ticker",),
    max_n: int | None = 100,
) -> DataFrame:
    """The newest ``n`` rows per key. Spark keeps n rows per key and map task before it shuffles."""
    if n < 1 or (max_n is not None and n > max_n):
        raise ValueError(f"n must be between 1 and {max_n}")
    newest = Window.partitionBy(*by).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("rank", F.row_number().over(newest).cast("bigint")).filter(F.col("rank") <= n)
