"""Per-tick rolling metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions.rules import spike_level
from tickloom.operators import rolling
from tickloom.plans.catalogue import query
from tickloom.plans.views import sql
from tickloom.sources import adapters as src

_ID = "ticker, ts_us, seq"


@query(sql("enriched", f"SELECT {_ID}, vwap_1min AS vwap FROM enriched"))
def vwap_trailing_60s(spark, d):
    return rolling.trailing_vwap(src.ticks(spark, d), 60).select("ticker", "ts_us", "seq", "vwap")


@query(sql("enriched", f"SELECT {_ID}, vwap_5min AS vwap FROM enriched"))
def vwap_trailing_300s(spark, d):
    return rolling.trailing_vwap(src.ticks(spark, d), 300).select("ticker", "ts_us", "seq", "vwap")


@query(sql("enriched", f"SELECT {_ID}, avg_price_5min AS avg_price FROM enriched"))
def avg_price_trailing_300s(spark, d):
    return rolling.trailing_mean_price(src.ticks(spark, d), 300).select("ticker", "ts_us", "seq", "avg_price")


@query(sql("enriched", f"SELECT {_ID}, trade_count_60s AS trade_count FROM enriched"))
def trade_count_60s(spark, d):
    return rolling.trailing_count(src.ticks(spark, d), 60).select("ticker", "ts_us", "seq", "trade_count")


@query(
    sql(
        "enriched",
        f"SELECT {_ID}, CASE WHEN vwap_5min <> 0 THEN price - vwap_5min ELSE 0.0 END AS vwap_deviation FROM enriched",
    )
)
def vwap_deviation(spark, d):
    return rolling.vwap_deviation(src.ticks(spark, d), 300).select("ticker", "ts_us", "seq", "vwap_deviation")


@query(sql("zprior", f"SELECT {_ID}, size, volume_zscore FROM zprior"))
def zscore_prior19(spark, d):
    return rolling.zscore_prior(src.ticks(spark, d)).select("ticker", "ts_us", "seq", "size", "volume_zscore")


@query(
    sql(
        "ticks",
        f"""SELECT {_ID}, CASE WHEN mn = mx THEN 0.0 ELSE ((n * x - s) / n) / sqrt((n * ss - s * s) / (n * n)) END AS volume_zscore
FROM (SELECT *, size::DOUBLE AS x, (count(*) OVER w)::DOUBLE AS n, (sum(size) OVER w)::DOUBLE AS s,
             (sum(size * size) OVER w)::DOUBLE AS ss, min(size) OVER w AS mn, max(size) OVER w AS mx
      FROM ticks WINDOW w AS (PARTITION BY ticker ORDER BY ts_us, seq ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))""",
    )
)
def zscore_incl20(spark, d):
    return rolling.zscore_inclusive(src.ticks(spark, d)).select("ticker", "ts_us", "seq", "volume_zscore")


@query(sql("enriched", f"SELECT {_ID}, momentum FROM enriched"))
def momentum_tick(spark, d):
    return rolling.momentum_tick(src.ticks(spark, d)).select("ticker", "ts_us", "seq", "momentum")


@query(
    sql(
        "ticks",
        f"""SELECT {_ID.replace('ticker', 't.ticker').replace('ts_us', 't.ts_us').replace(' seq', ' t.seq')},
       CASE WHEN b.price > 0 THEN (t.price - b.price) / b.price * 100.0 ELSE 0.0 END AS momentum
FROM ticks t ASOF LEFT JOIN ticks b ON t.ticker = b.ticker AND t.ts_us - 60000000 >= b.ts_us""",
    )
)
def momentum_60s(spark, d):
    return rolling.momentum_ago(src.ticks(spark, d), 60).select("ticker", "ts_us", "seq", "momentum")


@query(
    sql(
        "ticks",
        f"""SELECT {_ID}, CASE WHEN ts_us - lag(ts_us) OVER w < 60000000 AND lag(price) OVER w > 0
       THEN (price - lag(price) OVER w) / (lag(price) OVER w) * 100.0 ELSE 0.0 END AS momentum
FROM ticks WINDOW w AS (PARTITION BY ticker ORDER BY ts_us, seq)""",
    )
)
def momentum_gap60(spark, d):
    return rolling.momentum_gap(src.ticks(spark, d), 60).select("ticker", "ts_us", "seq", "momentum")


@query(
    sql(
        "ticks",
        f"""SELECT {_ID}, CASE WHEN sum(size) OVER w > 0 THEN (sum(price * size) OVER w) / (sum(size) OVER w)::DOUBLE ELSE 0.0 END AS vwap
FROM ticks WINDOW w AS (PARTITION BY ticker ORDER BY ts_us, seq ROWS UNBOUNDED PRECEDING)""",
    )
)
def vwap_running(spark, d):
    return rolling.running_vwap(src.ticks(spark, d)).select("ticker", "ts_us", "seq", "vwap")


@query(
    sql(
        "ticks",
        f"""SELECT {_ID}, count(*) OVER w / greatest(1e-6::DOUBLE, (ts_us % 60000000) / 60e6::DOUBLE) AS trade_rate
FROM ticks WINDOW w AS (PARTITION BY ticker, ts_us // 60000000 ORDER BY ts_us, seq ROWS UNBOUNDED PRECEDING)""",
    )
)
def trade_rate_running(spark, d):
    return rolling.running_trade_rate(src.ticks(spark, d)).select("ticker", "ts_us", "seq", "trade_rate")


@query(
    sql(
        "ticks",
        f"""SELECT {_ID}, array_to_string(list(size) OVER w, ',') AS sizes
FROM ticks WINDOW w AS (PARTITION BY ticker ORDER BY ts_us, seq ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
    )
)
def size_ring(spark, d):
    r = rolling.recent_sizes(src.ticks(spark, d))
    sizes = F.array_join(F.transform("sizes", lambda s: s.cast("string")), ",")
    return r.select("ticker", "ts_us", "seq", sizes.alias("sizes"))


@query(
    sql(
        "ticks",
        """SELECT key, ts_us, seq, (s::DOUBLE / n) AS mean_latency_ms, n >= 10 AND s::DOUBLE / n > 100.0 AS under_pressure
FROM (SELECT ticker AS key, ts_us, seq, sum((value * 2)::DECIMAL(18, 8)) OVER w AS s, count(*) OVER w AS n
      FROM ticks WINDOW w AS (PARTITION BY ticker ORDER BY ts_us, seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))""",
    )
)
def latency_pressure(spark, d):
    return rolling.latency_pressure(src.write_log(spark, d)).select(
        "key", "ts_us", "seq", "mean_latency_ms", "under_pressure"
    )


@query(
    sql(
        "zprior",
        f"""SELECT {_ID}, volume_zscore, CASE WHEN volume_zscore > 3 THEN 'extreme' WHEN volume_zscore > 2 THEN 'unusual' ELSE 'normal' END AS spike
FROM zprior""",
    )
)
def volume_spikes(spark, d):
    z = rolling.zscore_prior(src.ticks(spark, d))
    return z.select("ticker", "ts_us", "seq", "volume_zscore", spike_level("volume_zscore").alias("spike"))


@query(sql("ticks", f"SELECT {_ID}, row_number() OVER (PARTITION BY ticker ORDER BY ts_us, seq) AS sequence FROM ticks"))
def sequence_stamp(spark, d):
    return rolling.ordinals(src.ticks(spark, d), out="sequence").select("ticker", "ts_us", "seq", "sequence")


@query(
    sql(
        "enriched",
        f"""SELECT {_ID}, price, size, vwap_1min, vwap_5min, avg_price_5min, trade_count_60s, volume_zscore, momentum
FROM enriched""",
    ),
    name="enriched_market_events",
)
def enriched_market_events(spark, d):
    return rolling.enrich(src.ticks(spark, d))
