"""Operational metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import rules
from tickloom.operators import monitor, normalize
from tickloom.plans.catalogue import query
from tickloom.plans.views import sql
from tickloom.sources import adapters as src

AS_OF_US = src.EPOCH_US + src.SPAN_S * 1_000_000


@query(
    sql(
        "requests",
        f"""WITH counted AS (SELECT *, path = '/market-prices' OR path LIKE '/quote/%' OR path LIKE '/sentiment/%' AS ext FROM requests WHERE path NOT LIKE '/static%'),
lat AS (SELECT latency_ms, row_number() OVER (ORDER BY latency_ms) AS r FROM
        (SELECT latency_ms FROM counted WHERE NOT ext ORDER BY ts_us DESC, seq DESC LIMIT 100)),
tot AS (SELECT count(*) AS total_requests, count(*) FILTER (ts_us > {AS_OF_US} - 60000000 AND ts_us <= {AS_OF_US}) AS requests_per_minute,
               count(*) FILTER (status >= 400) AS error_count FROM counted),
pct AS (SELECT max(latency_ms) FILTER (r = 51) AS p50_ms, max(latency_ms) FILTER (r = 100) AS p99_ms,
               sum(latency_ms::DECIMAL(18,8))::DOUBLE / count(*) AS mean_ms FROM lat)
SELECT p50_ms, p99_ms, mean_ms, total_requests, requests_per_minute, error_count, error_count / total_requests * 100.0::DOUBLE AS error_rate_pct,
       CASE WHEN p99_ms < 200 THEN 'healthy' ELSE 'degraded' END AS status FROM pct, tot""",
    )
)
def latency_stats(spark, d):
    r = normalize.request_details(src.request_log(spark, d))
    return monitor.latency_stats(r, AS_OF_US)


@query(
    sql(
        "ticks",
        """SELECT key, max(l) FILTER (r = ceil(n * 0.5)) AS p50_ms, max(l) FILTER (r = ceil(n * 0.99)) AS p99_ms, max(n) AS n
FROM (SELECT ticker AS key, value * 2 AS l, row_number() OVER (PARTITION BY ticker ORDER BY value) AS r,
             count(*) OVER (PARTITION BY ticker) AS n FROM ticks) GROUP BY key""",
    )
)
def latency_by_key(spark, d):
    return monitor.latency_by_key(src.write_log(spark, d))


@query(
    """SELECT topic, sum(greatest(0, high - coalesce(committed, low)))::BIGINT AS lag, count(*) AS partitions
FROM (SELECT o_orderstatus AS topic, substring(o_orderpriority, 1, 1) AS p, min(o_orderkey) AS low, max(o_orderkey) AS high,
             max(o_orderkey) FILTER (o_custkey % 4 = 0 AND o_orderpriority NOT LIKE '5%') AS committed
      FROM orders GROUP BY ALL) GROUP BY topic"""
)
def consumer_lag(spark, d):
    return monitor.consumer_lag(src.offsets(spark, d))


def _metrics(spark, d):
    """One metric row per event, names and sizes varying."""
    names = ["ConsumerLag", "StoreWriteLatencyP99", "DeadLetterDepth", "ReadLatencyP99", "Unlisted"]
    name = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("seq") % 5 + 1).cast("int"))
    factor = F.when(F.col("seq") % 5 == 0, 100.0).otherwise(1.0)
    return src.ticks(spark, d).select(
        "seq", "ts_us", "ticker", name.alias("name"), (F.col("size") * factor).alias("value")
    )


_METRICS = """metrics AS (SELECT seq, ts_us, ticker, ['ConsumerLag','StoreWriteLatencyP99','DeadLetterDepth','ReadLatencyP99','Unlisted'][seq % 5 + 1] AS name,
  size * CASE WHEN seq % 5 = 0 THEN 100.0::DOUBLE ELSE 1.0 END AS value FROM ticks)"""


@query(
    sql(
        "ticks",
        f"""WITH {_METRICS} SELECT seq, name, value,
       CASE WHEN value >= critical THEN 'critical' WHEN value >= warning THEN 'warning' ELSE 'ok' END AS level
FROM metrics LEFT JOIN (VALUES ('ConsumerLag', 5000, 10000), ('StoreWriteLatencyP99', 50, 100), ('DeadLetterDepth', 50, 100), ('ReadLatencyP99', 200, 500)) t(name, warning, critical) USING (name)""",
    )
)
def alert_levels(spark, d):
    return monitor.alert_levels(_metrics(spark, d).select("seq", "name", "value"))


@query(
    sql(
        "ticks",
        f"""WITH {_METRICS} SELECT name, ticker, ts_us - ts_us % 10000000 AS window_start_us, sum(value) AS value, count(*) AS samples
FROM metrics GROUP BY ALL""",
    )
)
def metric_rollup(spark, d):
    return monitor.metric_rollup(_metrics(spark, d), "ticker")


@query(
    sql(
        "ticks",
        """SELECT pk, max(n)::DOUBLE AS peak_writes_per_s, sum(n)::BIGINT AS writes FROM (
  SELECT ticker AS pk, ts_us // 1000000 AS w, count(*) AS n FROM ticks GROUP BY ALL
  UNION ALL SELECT ticker || '#' || (seq % 8), ts_us // 1000000, count(*) FROM ticks GROUP BY ALL) GROUP BY pk""",
    )
)
def hot_keys(spark, d):
    """Peak write rate of each ticker, and of each shard of it."""
    log = src.write_log(spark, d).withColumnRenamed("key", "ticker")
    plain = monitor.write_rates(log, F.col("ticker"))
    return plain.unionByName(monitor.write_rates(log, rules.sequence_shard_key()))


@query(
    sql(
        "ticks",
        """SELECT ticker, count(*) AS n, round(avg(price), 6) AS price_mean, round(stddev_pop(price), 6) AS price_std,
       round(avg(size), 6) AS size_mean, round(stddev_pop(size), 6) AS size_std FROM ticks GROUP BY ticker""",
    )
)
def feature_stats(spark, d):
    s = monitor.feature_stats(src.ticks(spark, d), ["price", "size"])
    return s.select("ticker", "n", *[F.round(c, 6).alias(c) for c in s.columns[2:]])


@query(
    sql(
        "ticks",
        """SELECT seq, round((price - pm) / ps, 6) AS price, round((size - sm) / ss, 6) AS size
FROM ticks JOIN (SELECT ticker, avg(price) AS pm, stddev_pop(price) AS ps, avg(size) AS sm, stddev_pop(size) AS ss FROM ticks GROUP BY ticker) USING (ticker)""",
    )
)
def standardize(spark, d):
    t = src.ticks(spark, d)
    s = monitor.standardize(t, monitor.feature_stats(t, ["price", "size"]), ["price", "size"])
    return s.select("seq", F.round("price", 6).alias("price"), F.round("size", 6).alias("size"))
