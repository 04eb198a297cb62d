"""Read views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import rules
from tickloom.operators import keyed, rolling, serving, windows
from tickloom.plans import composites
from tickloom.plans.catalogue import query
from tickloom.plans.views import sql
from tickloom.sources import adapters as src

# An "as of" inside the data and a range before it.
AS_OF_US = src.EPOCH_US + 20_000 * 1_000_000
RANGE_US = (src.EPOCH_US + 3_600 * 1_000_000, src.EPOCH_US + 7_200 * 1_000_000)


def _quote_rows(spark, d):
    return rolling.enrich(src.ticks(spark, d)).drop("avg_price_5min", "trade_count_60s")


@query(
    sql(
        "enriched",
        """SELECT ticker, price, size, ts_us, seq, vwap_1min, vwap_5min, volume_zscore, momentum, rank
FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY ts_us DESC, seq DESC) AS rank FROM enriched) WHERE rank <= 10""",
    )
)
def quotes_latest_n(spark, d):
    return serving.quotes(_quote_rows(spark, d), 10)


@query(
    sql(
        "ticks",
        f"SELECT ticker, price, size, ts_us, seq FROM ticks WHERE ticker = 'CLICK' AND ts_us BETWEEN {RANGE_US[0]} AND {RANGE_US[1]}",
    )
)
def quotes_time_range(spark, d):
    from tickloom.sources.readers import keyed_rows

    return keyed_rows(src.ticks(spark, d), "CLICK", start_us=RANGE_US[0], end_us=RANGE_US[1])


@query(
    sql(
        "enriched",
        """SELECT * EXCLUDE (r) FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY window_start_us DESC) AS r FROM (
    SELECT ticker, ts_us - ts_us % 60000000 AS window_start_us, ts_us - ts_us % 60000000 + 60000000 AS window_end_us,
           arg_max(vwap_1min, ts_us) AS vwap_1min, arg_max(vwap_5min, ts_us) AS vwap_5min,
           arg_max(avg_price_5min, ts_us) AS avg_price_5min, arg_max(volume_zscore, ts_us) AS volume_zscore,
           arg_max(momentum, ts_us) AS momentum, count(*)::DOUBLE AS trade_frequency
    FROM enriched GROUP BY ALL)) WHERE r = 1""",
    )
)
def aggregations_latest(spark, d):
    return serving.aggregations(windows.aggregation_rows(rolling.enrich(src.ticks(spark, d))))


def _feature_table(spark, d):
    e = rolling.enrich(src.ticks(spark, d))
    return e.select(
        "ticker", "ts_us", "seq", "vwap_5min", "volume_zscore", "momentum", rules.expires_at("features").alias("ttl")
    )


_FEATURES_SQL = """SELECT ticker, ts_us, seq, vwap_5min, volume_zscore, momentum, ts_us // 1000000 + 604800 AS ttl
FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY ts_us DESC, seq DESC) AS r FROM enriched {where}) WHERE r = 1"""


@query(sql("enriched", _FEATURES_SQL.format(where="")))
def features_latest(spark, d):
    return serving.features(_feature_table(spark, d))


@query(
    sql(
        "enriched",
        _FEATURES_SQL.format(where=f"WHERE ts_us <= {AS_OF_US} AND ts_us >= {AS_OF_US} - {AS_OF_US} % 3600000000"),
    )
)
def features_current_hour(spark, d):
    return serving.features(_feature_table(spark, d), as_of_us=AS_OF_US, bucket_only=True)


def _signals(spark, d):
    return composites.news_signals(src.ticks(spark, d), src.news(spark, d), src.lexicon(spark))


@query(
    sql(
        "signals",
        """SELECT id, ticker, ts_us, compound, sentiment_label, correlation_strength, rank
FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY ts_us DESC, id DESC) AS rank FROM signals) WHERE rank <= 50""",
    )
)
def sentiment_latest_n(spark, d):
    return serving.sentiment(_signals(spark, d), 50).select(
        "id", "ticker", "ts_us", "compound", "sentiment_label", "correlation_strength", "rank"
    )


@query(
    sql(
        "signals",
        """SELECT ticker, count(*) FILTER (compound >= 0.05) AS positive, count(*) FILTER (abs(compound) < 0.05) AS neutral,
       count(*) FILTER (compound <= -0.05) AS negative, sum(floor(compound * 1e9 + 0.5)::BIGINT)::DOUBLE / count(*) / 1e9 AS avg_compound,
       count(*) FILTER (correlation_strength = 'strong') AS strong_correlations
FROM signals GROUP BY ticker""",
    )
)
def sentiment_summary(spark, d):
    return serving.sentiment_summary(_signals(spark, d))


@query(
    sql(
        "scored",
        """SELECT ticker, ts_us, id, compound, headline
FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY ts_us DESC, id DESC) AS r FROM scored) WHERE r = 1""",
    )
)
def latest_sentiment(spark, d):
    return serving.latest_sentiment(composites.scored_news(src.news(spark, d), src.lexicon(spark)))


@query(
    sql(
        "scored",
        f"SELECT id, ticker, ts_us, compound FROM scored WHERE ts_us > {AS_OF_US} - 3600000000 AND ts_us <= {AS_OF_US}",
    )
)
def sentiment_lookback(spark, d):
    s = composites.scored_news(src.news(spark, d), src.lexicon(spark))
    recent = keyed.look_back(s.filter(F.col("ts_us") <= AS_OF_US), 1, AS_OF_US, inclusive=False)
    return recent.select("id", "ticker", "ts_us", "compound")


@query(
    sql(
        "ticks",
        """SELECT ticker, CASE WHEN p > 0 THEN p WHEN ticker = 'ERROR' THEN 42.5 ELSE 100.0 END AS price,
       CASE WHEN p > 0 THEN 1.5 WHEN ticker = 'ERROR' THEN 0.25 ELSE 0.0 END::DOUBLE AS change_pct,
       CASE WHEN p > 0 THEN p - 1 WHEN ticker = 'ERROR' THEN 42.0 ELSE 100.0 END AS previous_close,
       CASE WHEN p > 0 THEN 'live' WHEN ticker = 'ERROR' THEN 'static' ELSE 'default' END AS origin
FROM (SELECT x.ticker, CASE WHEN x.ticker IN ('ERROR', 'VIEW') THEN 0.0 ELSE l.p END AS p
      FROM (SELECT DISTINCT ticker FROM ticks UNION ALL SELECT 'NEW') x
      LEFT JOIN (SELECT ticker, arg_max(price, (ts_us, seq)) AS p FROM ticks GROUP BY ticker) l ON x.ticker = l.ticker)""",
    )
)
def prices_with_fallback(spark, d):
    """Last prices of all tickers; two come without a usable price and one is not traded."""
    last = src.ticks(spark, d).groupBy("ticker").agg(F.max_by("price", F.struct("ts_us", "seq")).alias("price"))
    wanted = last.select("ticker").unionByName(spark.createDataFrame([("NEW",)], "ticker string"))
    live = last.select(
        "ticker",
        F.when(F.col("ticker").isin("ERROR", "VIEW"), 0.0).otherwise(F.col("price")).alias("price"),
        F.lit(1.5).alias("change_pct"),
        (F.col("price") - 1).alias("previous_close"),
    )
    return serving.prices(live, wanted, {"ERROR": (42.5, 0.25, 42.0)})
