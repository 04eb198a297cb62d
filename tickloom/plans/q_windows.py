"""Window aggregates."""

from __future__ import annotations

from tickloom.operators import rolling, windows
from tickloom.plans import composites
from tickloom.plans.catalogue import query
from tickloom.plans.views import sql
from tickloom.sources import adapters as src


def _vwap_sql(width_s: int) -> str:
    w = width_s * 1_000_000
    return sql(
        "ticks",
        f"""SELECT ticker, ts_us - ts_us % {w} AS window_start_us,
       CASE WHEN sum(size) > 0 THEN sum(price * size) / sum(size)::DOUBLE ELSE 0.0 END AS vwap,
       sum(size)::BIGINT AS volume, count(*) AS trade_count
FROM ticks GROUP BY ALL""",
    )


@query(_vwap_sql(60))
def vwap_1min_tumbling(spark, d):
    return windows.vwap_tumbling(src.ticks(spark, d), 60)


@query(_vwap_sql(300))
def vwap_5min_tumbling(spark, d):
    return windows.vwap_tumbling(src.ticks(spark, d), 300)


@query(
    sql(
        "ticks",
        """SELECT ticker, ts_us - ts_us % 60000000 - i * 60000000 AS window_start_us,
       sum(price) / count(*) AS avg_price, count(*) AS trade_count
FROM ticks, range(5) r(i) GROUP BY ALL""",
    )
)
def avg_price_hopping(spark, d):
    return windows.mean_price_hopping(src.ticks(spark, d))


@query(
    sql(
        "ticks",
        """SELECT ticker, ts_us - ts_us % 60000000 AS window_start_us, count(*)::DOUBLE AS trades_per_minute
FROM ticks GROUP BY ALL""",
    )
)
def trade_frequency_1min(spark, d):
    return windows.trade_frequency(src.ticks(spark, d))


@query(sql("tradewin", "SELECT * FROM tradewin"))
def trade_window_summary(spark, d):
    return composites.trade_windows(src.ticks(spark, d))


@query(sql("newswin", "SELECT * FROM newswin"))
def news_window_summary(spark, d):
    return composites.news_windows(src.news(spark, d), src.lexicon(spark))


@query(
    sql(
        "enriched",
        """SELECT ticker, ts_us - ts_us % 60000000 AS window_start_us, ts_us - ts_us % 60000000 + 60000000 AS window_end_us,
       arg_max(vwap_1min, ts_us) AS vwap_1min, arg_max(vwap_5min, ts_us) AS vwap_5min,
       arg_max(avg_price_5min, ts_us) AS avg_price_5min, arg_max(volume_zscore, ts_us) AS volume_zscore,
       arg_max(momentum, ts_us) AS momentum, count(*)::DOUBLE AS trade_frequency
FROM enriched GROUP BY ALL""",
    )
)
def aggregation_rows(spark, d):
    return windows.aggregation_rows(rolling.enrich(src.ticks(spark, d)))


@query(
    sql(
        "ticks",
        "SELECT ticker, ts_us - ts_us % 10000000 AS window_start_us, count(*) / 10.0::DOUBLE AS events_per_s FROM ticks GROUP BY ALL",
    )
)
def throughput_10s(spark, d):
    return windows.throughput(src.ticks(spark, d))
