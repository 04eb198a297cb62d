"""Bringing news and volume together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.rules import UNUSUAL_Z
from tickloom.operators.ordered import last_known

WINDOW_S = 60


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    values: list[str],
    *,
    tolerance_s: int | None = 60,
    **opts,
) -> DataFrame:
    """Left rows with the newest right ``values`` of their ticker at or before them.

    A right row older than ``tolerance_s`` gives nulls. ``right`` needs ticker, ts_us
    and seq.
    """
    packed = right.select(
        "ticker", "ts_us", "seq", F.struct(F.col("ts_us").alias("_then"), *values).alias("_asof")
    )
    t = last_known(left, packed, value="_asof", **opts)
    if tolerance_s is not None:
        fresh = F.col("ts_us") - F.col("_asof._then") <= tolerance_s * 1_000_000
        t = t.withColumn("_asof", F.when(fresh, F.col("_asof")))
    return t.select(*left.columns, *[F.col(f"_asof.{v}").alias(v) for v in values])


def joined_windows(trade_windows: DataFrame, news_windows: DataFrame) -> DataFrame:
    """Windows in which a ticker both traded and was in the news, with a strength flag."""
    both = trade_windows.join(news_windows, ["ticker", "window_start_us"])
    return both.select(
        "ticker",
        F.floor(F.col("window_start_us") / (WINDOW_S * 1_000_000)).cast("bigint").alias("window_id"),
        "window_start_us",
        (F.col("window_start_us") + WINDOW_S * 1_000_000).alias("window_end_us"),
        F.col("max_zscore").alias("volume_zscore"),
        F.col("best_compound").alias("sentiment_compound"),
        "trade_count",
        "news_count",
        (F.col("had_strong_sentiment") & (F.col("max_zscore") > UNUSUAL_Z)).alias("is_strong"),
    )


def strong_correlations(trade_windows: DataFrame, news_windows: DataFrame) -> DataFrame:
    """Windows with strong sentiment and unusual volume.

    Both filters are applied before the join, so only candidate windows are shuffled.
    """
    return (
        joined_windows(
            trade_windows.filter(F.col("max_zscore") > UNUSUAL_Z),
            news_windows.filter("had_strong_sentiment"),
        )
        .filter("is_strong")
        .drop("is_strong", "trade_count", "news_count")
        .withColumn("correlation_type", F.lit("strong_correlation"))
    )
