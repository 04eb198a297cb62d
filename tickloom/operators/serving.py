"""Read views over the keyed tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.rules import sentiment_label
from tickloom.operators import keyed


def _ticker(df: DataFrame, ticker: str | None) -> DataFrame:
    return df if ticker is None else df.filter(F.col("ticker") == ticker.upper())


def quotes(
    df: DataFrame,
    limit: int = 1,
    *,
    ticker: str | None = None,
    start_us: int | None = None,
    end_us: int | None = None,
) -> DataFrame:
    """The newest ``limit`` quote rows per ticker over all shards."""
    d = keyed.between(_ticker(df, ticker), start_us, end_us)
    return keyed.latest_n(quote_items(d), limit)


def quote_items(df: DataFrame) -> DataFrame:
    """Quote rows with missing metrics as 0."""
    metrics = ["vwap_1min", "vwap_5min", "volume_zscore", "momentum"]
    have = [c for c in metrics if c in df.columns]
    return df.select(
        *[c for c in df.columns if c not in have],
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in have],
        *[F.lit(0.0).alias(c) for c in metrics if c not in have],
    )


def aggregations(
    df: DataFrame, *, ticker: str | None = None, start_us: int | None = None, end_us: int | None = None
) -> DataFrame:
    """The newest window of each ticker."""
    d = _ticker(df, ticker).withColumn("ts_us", F.col("window_start_us"))
    return keyed.keep_last(keyed.between(d, start_us, end_us).drop("ts_us"), ["ticker"], ["window_start_us"])


def anomalies(
    df: DataFrame,
    limit: int = 100,
    *,
    ticker: str | None = None,
    hours: int | None = None,
    as_of_us: int | None = None,
) -> DataFrame:
    """The newest flagged rows per ticker, optionally of the last hours only."""
    d = _ticker(df, ticker).filter("is_anomaly")
    if hours is not None:
        d = keyed.look_back(d, hours, as_of_us)
    return keyed.latest_n(d, limit)


def features(
    df: DataFrame, *, ticker: str | None = None, as_of_us: int | None = None, bucket_only: bool = False
) -> DataFrame:
    """The newest feature row per ticker that is not expired.

    ``bucket_only`` looks in the hour of ``as_of_us`` only.
    """
    d = _ticker(df, ticker)
    if as_of_us is not None:
        d = keyed.live(d.filter(F.col("ts_us") <= as_of_us), as_of_us)
        if bucket_only:
            hour = as_of_us - as_of_us % 3_600_000_000
            d = d.filter(F.col("ts_us") >= hour)
    return keyed.keep_last(d, ["ticker"], ["ts_us", "seq"])


def sentiment(
    df: DataFrame,
    limit: int = 50,
    *,
    ticker: str | None = None,
    hours: int | None = None,
    as_of_us: int | None = None,
) -> DataFrame:
    """The newest articles per ticker."""
    d = _ticker(df, ticker)
    if hours is not None:
        d = keyed.look_back(d, hours, as_of_us, inclusive=False)
    return keyed.latest_n(d, limit, order=("ts_us", "id"))


def sentiment_summary(df: DataFrame, inclusive: bool = True) -> DataFrame:
    """Articles by label, mean compound and strong links per ticker.

    The mean is of compounds rounded to billionths (halves up), which are summed as whole
    numbers, so it does not depend on the order of rows.
    """
    label = sentiment_label("compound", inclusive)
    strong = F.col("correlation_strength") == "strong" if "correlation_strength" in df.columns else F.lit(False)
    return df.groupBy("ticker").agg(
        F.count_if(label == "positive").alias("positive"),
        F.count_if(label == "neutral").alias("neutral"),
        F.count_if(label == "negative").alias("negative"),
        (F.sum(F.floor(F.col("compound") * 1e9 + 0.5)).cast("double") / F.count("*") / 1e9).alias("avg_compound"),
        F.count_if(strong).alias("strong_correlations"),
    )


def latest_sentiment(df: DataFrame, max_chars: int | None = None) -> DataFrame:
    """Last compound, time and headline per ticker; ``max_chars`` shortens headlines."""
    headline = F.col("headline") if max_chars is None else F.substring("headline", 1, max_chars)
    short = df.select("ticker", "ts_us", "id", "compound", headline.alias("headline"))
    return keyed.keep_last(short, ["ticker"], ["ts_us", "id"])


def prices(df: DataFrame, tickers: DataFrame, static: Mapping[str, tuple[float, float, float]]) -> DataFrame:
    """One price row per wanted ticker: live if positive, else a static one, else 100.

    ``df`` has ticker, price, change_pct, previous_close, one row per ticker; ``static``
    maps tickers to the same three values.
    """
    fixed = tickers.sparkSession.createDataFrame(
        [(k, *v) for k, v in static.items()],
        "ticker string, s_price double, s_change_pct double, s_previous_close double",
    )
    live = F.coalesce(F.col("price") > 0, F.lit(False))

    def pick(c: str, last: float) -> Column:
        return F.when(live, F.col(c)).otherwise(F.coalesce(f"s_{c}", F.lit(last))).alias(c)

    # The static table comes from a Python mapping, so it is small.
    return (
        tickers.join(df, "ticker", "left")
        .join(F.broadcast(fixed), "ticker", "left")
        .select(
            "ticker",
            pick("price", 100.0),
            pick("change_pct", 0.0),
            pick("previous_close", 100.0),
            F.when(live, "live").when(F.col("s_price").isNotNull(), "static").otherwise("default").alias("origin"),
        )
    )
