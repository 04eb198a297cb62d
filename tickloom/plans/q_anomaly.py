"""Features and anomalies."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import anomaly, normalize, rolling, serving, validate
from tickloom.plans.catalogue import query
from tickloom.plans.forest_sql import scored_sql, trees_sql
from tickloom.plans.q_records import MIXED_SQL, mixed_ticks
from tickloom.plans.views import sql
from tickloom.session import shared_folder
from tickloom.sources import adapters as src

_ORD = "row_number() OVER (PARTITION BY ticker ORDER BY ts_us, seq)"


@query(
    sql(
        "enriched",
        """SELECT ticker, ts_us, seq, price, size::DOUBLE AS volume, vwap_1min, volume_zscore, momentum,
       0.0::DOUBLE AS bid_ask_spread, trade_count_60s::DOUBLE AS trade_frequency FROM enriched""",
    )
)
def features_7d(spark, d):
    return anomaly.features_7d(src.ticks(spark, d))


_FEATURES_6D = """SELECT ticker, ts_us, seq, price, size::DOUBLE AS volume,
       CASE WHEN mn2 = mx2 THEN 0.0 ELSE ((n2 * x - s2) / n2) / sqrt(spread2 / (n2 * n2)) END AS volume_zscore,
       CASE WHEN ts_us - pts < 60000000 THEN momentum ELSE 0.0 END AS price_momentum,
       CASE WHEN vwap_5min <> 0 THEN price - vwap_5min ELSE 0.0 END AS vwap_deviation, trade_count_60s::DOUBLE AS trade_frequency
FROM (SELECT *, (count(*) OVER w)::DOUBLE AS n2, (sum(size) OVER w)::DOUBLE AS s2,
             ((count(*) OVER w) * (sum(size::HUGEINT * size) OVER w) - (sum(size) OVER w) * (sum(size) OVER w))::DOUBLE AS spread2,
             min(size) OVER w AS mn2, max(size) OVER w AS mx2, lag(ts_us) OVER (PARTITION BY ticker ORDER BY ts_us, seq) AS pts
      FROM enriched WINDOW w AS (PARTITION BY ticker ORDER BY ts_us, seq ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))"""


@query(sql("enriched", _FEATURES_6D))
def features_6d(spark, d):
    return anomaly.features_6d(src.ticks(spark, d))


@query(
    sql(
        "ticks",
        f"SELECT ticker, ts_us, seq, n AS ordinal, (n - 1) // 1000 AS epoch, n < 500 AS warming_up FROM (SELECT *, {_ORD} AS n FROM ticks)",
    )
)
def model_epochs(spark, d):
    return anomaly.epochs(src.ticks(spark, d).select("ticker", "ts_us", "seq"))


@query(
    sql(
        "ticks",
        f"""SELECT ticker, v AS version, count(*) AS n
FROM (SELECT ticker, {_ORD} AS o, count(*) OVER (PARTITION BY ticker) AS total FROM ticks), range(1, 1000) r(v)
WHERE v * 1000 <= total AND o > v * 1000 - 5000 AND o <= v * 1000 GROUP BY ALL""",
    )
)
def training_sets(spark, d):
    return anomaly.training_counts(rolling.ordinals(src.ticks(spark, d)))


@query(
    sql(
        "ticks",
        f"""SELECT ticker, v AS version, count(*) AS n
FROM (SELECT ticker, {_ORD} AS o, count(*) OVER (PARTITION BY ticker) AS total FROM ticks), range(2, 2000) r(v)
WHERE v * 500 <= total AND o > v * 500 - 1000 AND o <= v * 500 GROUP BY ALL""",
    )
)
def training_sets_short(spark, d):
    """Refit every 500 events on the last 1,000."""
    f = anomaly.Forest(window=1000, interval=500, warmup=1000, contamination=0.01)
    return anomaly.training_counts(rolling.ordinals(src.ticks(spark, d)), f)


def _featured(spark, d):
    return rolling.ordinals(anomaly.features_7d(src.ticks(spark, d)))


#: The scaled variant: refitted every 500 events on the last 1,000.
SCALED = anomaly.Forest(features=tuple(anomaly.FEATURES_6D), window=1000, interval=500, warmup=1000, contamination=0.01)

_MIXED = f"""WITH {MIXED_SQL},
live AS (SELECT * FROM mixed WHERE kind <> 'dlq'),
z AS (SELECT *, CASE WHEN n = 0 THEN 0.0 WHEN mn = mx THEN sign(size - mn)::DOUBLE ELSE ((n * x - s) / n) / sqrt(off / (n * (n - 1.0))) END AS volume_zscore
  FROM (SELECT *, size::DOUBLE AS x, (count(size) OVER w)::DOUBLE AS n, (sum(size) OVER w)::DOUBLE AS s,
               ((count(size) OVER w) * (sum(size::HUGEINT * size) OVER w) - (sum(size) OVER w) * (sum(size) OVER w))::DOUBLE AS off, min(size) OVER w AS mn, max(size) OVER w AS mx
        FROM live WINDOW w AS (PARTITION BY ticker ORDER BY ts_us, seq ROWS BETWEEN 19 PRECEDING AND 1 PRECEDING)))
SELECT ticker, ts_us, seq, kind, price, size, spread, volume_zscore,
       CASE WHEN lag(price) OVER wl > 0 THEN (price - lag(price) OVER wl) / (lag(price) OVER wl) * 100.0 ELSE 0.0 END AS momentum,
       (sum(price::DECIMAL(18,8) * size::DECIMAL(18,0)) OVER w1)::DOUBLE / (sum(size) OVER w1)::DOUBLE AS vwap_1min,
       (sum(price::DECIMAL(18,8)) OVER w5)::DOUBLE / count(*) OVER w5 AS avg_price_5min,
       count(*) OVER w1 AS trade_count_60s
FROM z
WINDOW w1 AS (PARTITION BY ticker ORDER BY ts_us RANGE BETWEEN 60000000 PRECEDING AND CURRENT ROW),
       w5 AS (PARTITION BY ticker ORDER BY ts_us RANGE BETWEEN 300000000 PRECEDING AND CURRENT ROW),
       wl AS (PARTITION BY ticker ORDER BY ts_us, seq)"""

# Mixed ticks as the feature table of a forest.
_MIXED_FEATURES = _MIXED.strip().removeprefix("WITH ").replace(
    "\nSELECT ticker, ts_us, seq, kind, price", ",\nenriched_mix AS (SELECT ticker, ts_us, seq, kind, price"
) + """),
featured AS (
  SELECT ticker, ts_us, seq, price, size::DOUBLE AS volume, vwap_1min, volume_zscore, momentum,
         coalesce(spread, 0.0) AS bid_ask_spread, trade_count_60s::DOUBLE AS trade_frequency FROM enriched_mix)"""

_COLUMNS = ", ".join(f"x[{i + 1}] AS {n}" for i, n in enumerate(anomaly.FEATURES_7D))
_FLAGGED = f"SELECT ticker, ts_us, seq, score, is_anomaly, greatest(version, 1) AS model_version, {_COLUMNS} FROM verdicts WHERE is_anomaly"


def _columns(flagged, *more):
    """Flagged rows with their features as columns instead of a map."""
    names = [F.element_at("features", n).alias(n) for n in anomaly.FEATURES_7D]
    return flagged.select(*anomaly.ID, "score", "is_anomaly", "model_version", *names, *more)


@query(trees_sql())
def iforest_trees(spark, d):
    """Every node of every forest."""
    return anomaly.nodes(anomaly.fit(_featured(spark, d)))


@query(scored_sql())
def iforest_scores(spark, d):
    return anomaly.score(_featured(spark, d)).drop(*anomaly.FEATURES_7D)


@query(scored_sql(SCALED, f"featured AS ({_FEATURES_6D})"))
def iforest_scores_6d(spark, d):
    """Scores of the scaled variant."""
    t = rolling.ordinals(anomaly.features_6d(src.ticks(spark, d)))
    return anomaly.score(t, SCALED).drop(*anomaly.FEATURES_6D)


@query(scored_sql())
def iforest_saved_versions(spark, d):
    """Forests saved and loaded again; each row is scored by the version valid at its time."""
    root = shared_folder(spark, "forests")
    t = _featured(spark, d)
    anomaly.save(anomaly.fit(t), root)
    return anomaly.score_with(t, anomaly.load(spark, root))


@query(scored_sql(featured=_MIXED_FEATURES, views="quotes", body=_FLAGGED))
def anomalies(spark, d):
    """Mixed ticks routed, enriched, scored; the flagged ones with their features."""
    routed = validate.dispatch(mixed_ticks(spark, d)).filter(F.col("kind") != "dlq")
    t = routed.select("ticker", "price", "size", "ts_us", "seq", "spread")
    return _columns(anomaly.flagged(anomaly.score(rolling.ordinals(anomaly.features_7d(t)))))


def _flagged(spark, d):
    return anomaly.flagged(anomaly.score(_featured(spark, d)))


_RANKED = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY ts_us DESC, seq DESC) AS rank FROM ({_FLAGGED}){{where}})
WHERE rank <= {{n}}"""
AS_OF_US = src.EPOCH_US + src.SPAN_S * 1_000_000


@query(scored_sql(body=_RANKED.format(where="", n=10)))
def anomalies_latest_n(spark, d):
    return _columns(serving.anomalies(_flagged(spark, d), 10), "rank")


@query(scored_sql(body=_RANKED.format(where=f" WHERE ts_us >= {AS_OF_US} - 3600000000", n=100)))
def anomalies_lookback(spark, d):
    return _columns(serving.anomalies(_flagged(spark, d), 100, hours=1, as_of_us=AS_OF_US), "rank")


@query(
    scored_sql(
        body="SELECT ticker, version, count(*) AS n, count(*) FILTER (is_anomaly) AS anomalies FROM verdicts GROUP BY ticker, version"
    )
)
def anomaly_counts(spark, d):
    s = anomaly.score(_featured(spark, d))
    return s.groupBy("ticker", "version").agg(F.count("*").alias("n"), F.count_if("is_anomaly").alias("anomalies"))


@query(
    scored_sql(
        body=f"""SELECT ticker || '#' || (seq % 8) AS pk, strftime(make_timestamp(ts_us), '%Y-%m-%dT%H:%M:%S.%fZ') || '#' || seq AS sk, ticker,
       strftime(make_timestamp(ts_us), '%Y-%m-%dT%H:%M:%S.%fZ') AS ts, ts_us // 1000000 + 2592000 AS ttl,
       score AS anomaly_score, is_anomaly, model_version, {", ".join(anomaly.FEATURES_7D)} FROM ({_FLAGGED})"""
    )
)
def keyed_anomaly_items(spark, d):
    """Flagged rows as keyed items; the feature vector is shown as columns."""
    names = [F.element_at("features", n).alias(n) for n in anomaly.FEATURES_7D]
    items = normalize.keyed_items(
        _flagged(spark, d), "anomalies", "seq", F.col("score").alias("anomaly_score"), "is_anomaly", "model_version", "features"
    )
    return items.select("*", *names).drop("features")


@query(sql("quotes", _MIXED))
def enriched_ticks(spark, d):
    """Trades and quotes routed to one tick stream, with all live metrics."""
    routed = validate.dispatch(mixed_ticks(spark, d)).filter(F.col("kind") != "dlq")
    t = routed.select("ticker", "price", "size", "ts_us", "seq", "spread", "kind")
    return rolling.enrich(t).drop("vwap_5min")
