"""News, sentiment and correlation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions.rules import correlation_strength, sentiment_label
from tickloom.operators import correlate, rolling, sentiment
from tickloom.plans import composites
from tickloom.plans.catalogue import query
from tickloom.plans.views import sql
from tickloom.sources import adapters as src


def _scored(spark, d):
    return composites.scored_news(src.news(spark, d), src.lexicon(spark))


@query(sql("texts", "SELECT id, ticker, text FROM texts WHERE text <> ''"))
def news_text(spark, d):
    return sentiment.news_text(src.news(spark, d)).select("id", "ticker", "text")


@query(
    sql(
        "scored",
        "SELECT id, ticker, n_tokens, n_hits, raw_score, compound, positive, neutral, negative FROM scored",
    )
)
def sentiment_scores(spark, d):
    return _scored(spark, d).drop("ts_us", "source", "headline")


@query(
    sql(
        "scored",
        """SELECT id, compound,
       CASE WHEN compound >= 0.05 THEN 'positive' WHEN compound <= -0.05 THEN 'negative' ELSE 'neutral' END AS label,
       CASE WHEN compound > 0.05 THEN 'positive' WHEN compound < -0.05 THEN 'negative' ELSE 'neutral' END AS strict_label
FROM scored""",
    )
)
def sentiment_labels(spark, d):
    return _scored(spark, d).select(
        "id",
        "compound",
        sentiment_label("compound").alias("label"),
        sentiment_label("compound", inclusive=False).alias("strict_label"),
    )


@query(sql("linked", "SELECT id, ticker, ts_us, volume_zscore FROM linked"))
def news_asof_zscore(spark, d):
    z = rolling.zscore_prior(src.ticks(spark, d))
    n = src.news(spark, d).select("id", "ticker", "ts_us")
    return correlate.asof_backward(n, z, ["volume_zscore"], tolerance_s=60)


@query(
    sql("signals", "SELECT id, compound, volume_zscore, correlation_strength AS strength FROM signals"),
    name="correlation_strength",
)
def correlation_strength_by_article(spark, d):
    z = rolling.zscore_prior(src.ticks(spark, d))
    j = correlate.asof_backward(_scored(spark, d), z, ["volume_zscore"], tolerance_s=60)
    strength = correlation_strength("compound", "volume_zscore").alias("strength")
    return j.select("id", "compound", "volume_zscore", strength)


@query(
    sql(
        "signals",
        """SELECT id, ticker, ts_us, source, compound, positive, neutral, negative, sentiment_label, volume_zscore,
       correlated, correlation_strength FROM signals""",
    )
)
def news_signals(spark, d):
    s = composites.news_signals(src.ticks(spark, d), src.news(spark, d), src.lexicon(spark))
    return s.drop("headline", "sentiment_score")


@query(
    sql(
        "tradewin newswin",
        """SELECT ticker, window_start_us // 60000000 AS window_id, window_start_us, window_start_us + 60000000 AS window_end_us,
       max_zscore AS volume_zscore, best_compound AS sentiment_compound, 'strong_correlation' AS correlation_type
FROM tradewin JOIN newswin USING (ticker, window_start_us) WHERE had_strong_sentiment AND max_zscore > 2.0""",
    )
)
def strong_correlations(spark, d):
    return composites.strong_correlations(src.ticks(spark, d), src.news(spark, d), src.lexicon(spark))


@query(
    sql(
        "tradewin newswin",
        """SELECT ticker, window_start_us // 60000000 AS window_id, window_start_us, window_start_us + 60000000 AS window_end_us,
       max_zscore AS volume_zscore, best_compound AS sentiment_compound, trade_count, news_count,
       had_strong_sentiment AND max_zscore > 2.0 AS is_strong
FROM tradewin JOIN newswin USING (ticker, window_start_us)""",
    )
)
def joined_windows(spark, d):
    return composites.joined_windows(src.ticks(spark, d), src.news(spark, d), src.lexicon(spark))


@query(
    sql(
        "signals",
        "SELECT ticker, sentiment_label AS label, count(*) AS n, avg(raw_score) AS mean_raw_score FROM signals GROUP BY ALL",
    )
)
def sentiment_by_label(spark, d):
    s = _scored(spark, d).withColumn("label", sentiment_label("compound"))
    return s.groupBy("ticker", "label").agg(
        F.count("*").alias("n"), (F.sum("raw_score") / F.count("*")).alias("mean_raw_score")
    )


@query(sql("signals", "SELECT ticker, correlation_strength AS strength, count(*) AS n FROM signals GROUP BY ALL"))
def correlation_by_strength(spark, d):
    s = composites.news_signals(src.ticks(spark, d), src.news(spark, d), src.lexicon(spark))
    return s.groupBy("ticker", F.col("correlation_strength").alias("strength")).agg(F.count("*").alias("n"))
