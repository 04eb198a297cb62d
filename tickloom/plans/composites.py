"""The questions a user asks, composed from operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.rules import UNUSUAL_Z, correlation_strength, sentiment_label
from tickloom.operators import correlate, rolling, sentiment, windows


def scored_news(news: DataFrame, lexicon: DataFrame, summary_chars: int | None = None) -> DataFrame:
    """News rows with sentiment: id, ticker, ts_us, source, compound, shares."""
    return sentiment.score(
        sentiment.news_text(news, summary_chars), lexicon, carry=("ticker", "ts_us", "source", "headline")
    )


def news_signals(ticks: DataFrame, news: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Every headline with its sentiment, the volume z-score at its time, and the link's strength."""
    scored = scored_news(news, lexicon)
    z = rolling.zscore_prior(ticks).select("ticker", "ts_us", "seq", "volume_zscore")
    joined = correlate.asof_backward(scored, z, ["volume_zscore"], tolerance_s=60)
    return joined.select(
        "id",
        "ticker",
        "ts_us",
        "source",
        "headline",
        F.round("compound", 4).alias("sentiment_score"),
        "compound",
        "positive",
        "neutral",
        "negative",
        sentiment_label("compound").alias("sentiment_label"),
        "volume_zscore",
        F.coalesce(F.col("volume_zscore") >= UNUSUAL_Z, F.lit(False)).alias("correlated"),
        correlation_strength("compound", "volume_zscore").alias("correlation_strength"),
    )


def trade_windows(ticks: DataFrame) -> DataFrame:
    return windows.trade_window_summary(rolling.enrich(ticks))


def zscore_windows(ticks: DataFrame) -> DataFrame:
    """Trade windows with the largest z and the count only, for joins that need no more."""
    return windows.tumbling(
        rolling.zscore_prior(ticks.select("ticker", "ts_us", "seq", "size")),
        60,
        F.max("volume_zscore").alias("max_zscore"),
        F.count("*").alias("trade_count"),
    )


def news_windows(news: DataFrame, lexicon: DataFrame) -> DataFrame:
    return windows.news_window_summary(scored_news(news, lexicon))


def joined_windows(ticks: DataFrame, news: DataFrame, lexicon: DataFrame) -> DataFrame:
    return correlate.joined_windows(zscore_windows(ticks), news_windows(news, lexicon))


def strong_correlations(ticks: DataFrame, news: DataFrame, lexicon: DataFrame) -> DataFrame:
    return correlate.strong_correlations(zscore_windows(ticks), news_windows(news, lexicon))
