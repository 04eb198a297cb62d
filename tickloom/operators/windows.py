"""Aggregates over epoch-aligned event-time windows.

Plain ``groupBy`` aggregates: Spark sums each map task's rows first, so a busy ticker
sends one row per window and task through the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.exact import exact, notional, ratio
from tickloom.functions.rules import STRONG_SENTIMENT, window_start

MICRO = 1_000_000


def tumbling(df: DataFrame, width_s: int, *aggs: Column, by: tuple[str, ...] = ("ticker",)) -> DataFrame:
    return df.groupBy(*by, window_start("ts_us", width_s).alias("window_start_us")).agg(*aggs)


def vwap_tumbling(df: DataFrame, width_s: int = 60) -> DataFrame:
    """VWAP, volume and trade count per ticker and window; VWAP is 0.0 without volume."""
    return tumbling(
        df,
        width_s,
        ratio(F.sum(notional()), F.sum("size")).alias("vwap"),
        F.sum("size").alias("volume"),
        F.count("*").alias("trade_count"),
    )


def mean_price_hopping(df: DataFrame, width_s: int = 300, hop_s: int = 60) -> DataFrame:
    """Mean price over windows of ``width_s`` that start every ``hop_s``.

    Rows are first summed per hop; only those few rows are copied to the windows they
    fall into, so the copies do not grow with the tick rate.
    """
    if hop_s <= 0 or width_s % hop_s:
        raise ValueError("width_s must be a multiple of hop_s")
    hops = tumbling(df, hop_s, F.sum(exact("price")).alias("_s"), F.count("*").alias("_n"))
    copies = [F.col("window_start_us") - i * hop_s * MICRO for i in range(width_s // hop_s)]
    return (
        hops.select("ticker", "_s", "_n", F.explode(F.array(*copies)).alias("window_start_us"))
        .groupBy("ticker", "window_start_us")
        .agg(
            (F.sum("_s").cast("double") / F.sum("_n")).alias("avg_price"),
            F.sum("_n").alias("trade_count"),
        )
    )


def trade_frequency(df: DataFrame, width_s: int = 60) -> DataFrame:
    """Trades per minute in each window."""
    per_minute = F.count("*") * 60.0 / width_s
    return tumbling(df, width_s, per_minute.alias("trades_per_minute"))


def trade_window_summary(enriched: DataFrame, width_s: int = 60) -> DataFrame:
    """Trade side of the news join: largest z, last metrics and count per window."""
    last = F.max_by(
        F.struct("vwap_1min", "vwap_5min", "momentum"), F.struct("ts_us", "seq")
    ).alias("_last")
    return tumbling(
        enriched, width_s, F.max("volume_zscore").alias("max_zscore"), last, F.count("*").alias("trade_count")
    ).select(
        "ticker",
        "window_start_us",
        "max_zscore",
        "_last.vwap_1min",
        "_last.vwap_5min",
        "_last.momentum",
        "trade_count",
    )


def news_window_summary(scored: DataFrame, width_s: int = 60) -> DataFrame:
    """News side of the join: strongest compound (the later one on ties) and count."""
    size = F.abs("compound")
    return tumbling(
        scored,
        width_s,
        F.max(size).alias("max_abs_compound"),
        F.max_by("compound", F.struct(size, "ts_us", "id")).alias("best_compound"),
        F.count("*").alias("news_count"),
        F.bool_or(size > STRONG_SENTIMENT).alias("had_strong_sentiment"),
    )


def aggregation_rows(enriched: DataFrame, width_s: int = 60) -> DataFrame:
    """One row per ticker and window with the metrics as of its last tick."""
    cols = ["vwap_1min", "vwap_5min", "avg_price_5min", "volume_zscore", "momentum"]
    last = F.max_by(F.struct(*cols), F.struct("ts_us", "seq")).alias("_last")
    per_minute = (F.count("*") * 60.0 / width_s).alias("trade_frequency")
    return tumbling(enriched, width_s, last, per_minute).select(
        "ticker",
        "window_start_us",
        (F.col("window_start_us") + width_s * MICRO).alias("window_end_us"),
        "_last.*",
        "trade_frequency",
    )


def throughput(df: DataFrame, width_s: int = 10) -> DataFrame:
    """Events per second and ticker in short windows."""
    return tumbling(df, width_s, (F.count("*") / float(width_s)).alias("events_per_s"))
