"""Streams run over the given tables until their end.

A table arrives in slices of its time, one in each micro-batch, so state crosses batches in
every query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import rules
from tickloom.operators import anomaly, rolling
from tickloom.plans.catalogue import query
from tickloom.plans.forest_sql import scored_sql
from tickloom.plans.views import sql
from tickloom.session import shared_folder
from tickloom.sources import adapters as src
from tickloom.sources import readers, schemas
from tickloom.streaming import streams

ONCE = {"availableNow": True}
SLICES = 8
SLICE_US = src.SPAN_S * 1_000_000 // SLICES


def arriving(df: DataFrame, name: str, slice_of: Column | None = None) -> DataFrame:
    """``df`` as a stream whose micro-batches are its slices, by default of its time.

    The rows are made once and set aside by slice; the slices are written one after the other,
    each by as many tasks as it has files.
    """
    spark = df.sparkSession
    root = shared_folder(spark, name)
    files = spark.sparkContext.defaultParallelism
    if slice_of is None:
        slice_of = F.floor((F.col("ts_us") - src.EPOCH_US) / SLICE_US)
    sliced = df.withColumn("_slice", F.least(F.greatest(slice_of, F.lit(0)), F.lit(SLICES - 1)).cast("int"))
    aside = shared_folder(spark, f"{name}-sliced")
    sliced.write.partitionBy("_slice").parquet(aside)
    sliced = spark.read.schema(sliced.schema).parquet(aside)
    for i in range(SLICES):
        sliced.filter(F.col("_slice") == i).drop("_slice").repartition(files).write.mode("append").parquet(root)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(root)


def tick_stream(spark, d, delay: str = streams.DELAY) -> DataFrame:
    return streams.timed(arriving(src.ticks(spark, d), "ticks"), delay)


def news_stream(spark, d, delay: str = streams.DELAY) -> DataFrame:
    return streams.timed(arriving(src.news(spark, d), "news"), delay)


@query(
    sql(
        "ticks",
        """SELECT ticker, w AS window_start_us, w + 60000000 AS window_end_us,
       CASE WHEN sum(size) > 0 THEN sum(price * size) / sum(size)::DOUBLE ELSE 0.0 END AS vwap, sum(size)::BIGINT AS volume, count(*) AS trade_count
FROM (SELECT *, ts_us - ts_us % 60000000 AS w FROM ticks) GROUP BY ticker, w""",
    )
)
def stream_vwap_1min(spark, d):
    stored = streams.run_once(streams.vwap(tick_stream(spark, d)), "stream_vwap")
    t = streams.timed(src.ticks(spark, d))
    mark = streams.final_watermark(t)
    return streams.with_open_windows(stored, streams.vwap(streams.since(t, mark, 60)), mark)


@query(
    sql(
        "ticks",
        """SELECT ticker, w AS window_start_us, w + 300000000 AS window_end_us, sum(price) / count(*) AS avg_price, count(*) AS trade_count
FROM (SELECT *, ts_us - ts_us % 60000000 - i * 60000000 AS w FROM ticks, range(5) r(i)) GROUP BY ticker, w""",
    )
)
def stream_avg_hopping(spark, d):
    stored = streams.run_once(streams.mean_price_hopping(tick_stream(spark, d)), "stream_hopping")
    t = streams.timed(src.ticks(spark, d))
    mark = streams.final_watermark(t)
    return streams.with_open_windows(stored, streams.mean_price_hopping(streams.since(t, mark, 300)), mark)


@query(
    sql(
        "enriched",
        """SELECT ticker, ts_us, seq, price, size, vwap_1min, vwap_5min, avg_price_5min, trade_count_60s, volume_zscore, momentum
FROM enriched""",
    )
)
def stream_enrich(spark, d):
    return streams.run_once(streams.enrich(tick_stream(spark, d)), "stream_enrich").drop("ts")


@query(
    sql(
        "enriched",
        """SELECT ticker, ts_us, seq, price, size, vwap_1min, vwap_5min, avg_price_5min, trade_count_60s, volume_zscore, momentum
FROM enriched""",
    )
)
def stream_enrich_spread(spark, d):
    """The same metrics with each micro-batch cut into time buckets, for tickers too hot for one task."""
    root = shared_folder(spark, "stream_spread")
    t = src.ticks(spark, d)
    streams.start_ordered(
        arriving(t, "ticks"), root, f"{root}/checkpoint", rolling.enrich, span_s=300, rows=rolling.ZSCORE_ROWS, trigger=ONCE
    ).awaitTermination()
    return spark.read.schema(rolling.enrich(t).schema).option("recursiveFileLookup", True).parquet(f"{root}/out")


@query(
    sql(
        "tradewin newswin",
        """SELECT ticker, max_zscore AS volume_zscore, best_compound AS sentiment_compound, trade_count, news_count,
       had_strong_sentiment AND max_zscore > 2.0 AS is_strong, window_start_us, window_start_us + 60000000 AS window_end_us
FROM tradewin JOIN newswin USING (ticker, window_start_us)""",
    )
)
def stream_correlations(spark, d):
    """Windows of news and of z-scores, which a hot ticker's ticks get spread over tasks."""
    root = shared_folder(spark, "stream_zscores")
    t, n = src.ticks(spark, d), src.news(spark, d)
    z = rolling.zscore_prior(t)
    streams.start_ordered(
        arriving(t, "ticks"), root, f"{root}/checkpoint", rolling.zscore_prior, span_s=0, rows=rolling.ZSCORE_ROWS, trigger=ONCE
    ).awaitTermination()
    files = {"maxFilesPerTrigger": spark.sparkContext.defaultParallelism}
    enriched = streams.timed(streams.ordered_stream(spark, f"{root}/out", z.schema, **files))
    scored = streams.score_news(news_stream(spark, d), src.lexicon(spark))
    stored = streams.run_once(streams.joined_windows(enriched, scored, strong_only=False), "stream_correlations")
    mark = streams.final_watermark(t, n)
    late_ticks = streams.timed(streams.since(z, mark, 60))
    late_news = streams.score_news(streams.timed(streams.since(n, mark, 60)), src.lexicon(spark))
    return streams.with_open_windows(stored, streams.joined_windows(late_ticks, late_news, strong_only=False), mark)


@query(
    sql(
        "linked",
        "SELECT id, ticker, ts_us, volume_zscore FROM linked",
    )
)
def stream_asof(spark, d):
    s = streams.asof(news_stream(spark, d), streams.enrich(tick_stream(spark, d)))
    matched = streams.run_once(s, "stream_asof")
    t, n = src.ticks(spark, d), src.news(spark, d)
    return streams.with_open_articles(n, matched, rolling.enrich(t), streams.final_watermark(t, n))


@query(sql("news", "SELECT id, ticker, ts_us FROM news"))
def stream_dedup(spark, d):
    n = news_stream(spark, d)
    twice = n.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"))
    return streams.run_once(streams.first_seen(twice, ["id"]).select("id", "ticker", "ts_us"), "stream_dedup")


_BROKEN = "['price', 'ticker', 'timestamp', 'event_type', 'json'][(seq // 50) % 5 + 1]"


@query(
    sql(
        "ticks",
        f"""SELECT CASE WHEN f IS NULL THEN 'valid' ELSE 'dead letter' END AS side, seq AS "offset", (seq % 6)::INT AS "partition",
       CASE f WHEN 'json' THEN NULL WHEN 'ticker' THEN lower(ticker) ELSE ticker END AS ticker,
       CASE WHEN f IS NULL THEN price END AS price, CASE WHEN f IS NULL THEN size END AS size, CASE WHEN f IS NULL THEN ts_us END AS ts_us,
       CASE WHEN f = 'json' THEN 'JsonError' WHEN f IS NOT NULL THEN 'ValidationError' END AS error_type,
       CASE WHEN f IS NOT NULL THEN 'market.trades' END AS topic, CASE WHEN f IS NOT NULL THEN 'validation' END AS queue,
       CASE WHEN f IS NOT NULL THEN ts_us + 1000000 END AS first_failed_us
FROM (SELECT *, CASE WHEN seq % 50 = 0 THEN {_BROKEN} END AS f FROM ticks)""",
    )
)
def stream_dlq_split(spark, d):
    """Valid rows and dead letters of a forked stream, row by row."""
    t = src.ticks(spark, d)
    raw = src.ticks_json_of(t).select(
        "raw",
        F.lit("market.trades").alias("topic"),
        F.pmod("seq", F.lit(6)).cast("int").alias("partition"),
        F.col("seq").alias("offset"),
        (F.col("ts_us") + 1_000_000).alias("received_us"),
    )
    slice_of = F.floor((F.col("received_us") - src.EPOCH_US) / SLICE_US)
    root = shared_folder(spark, "stream_split")
    streams.start_split(arriving(raw, "messages", slice_of), root, f"{root}/checkpoint", trigger=ONCE).awaitTermination()
    valid = spark.read.parquet(f"{root}/valid").select(
        F.lit("valid").alias("side"), "offset", "partition", "ticker", "price", F.col("volume").alias("size"), "ts_us"
    )
    dead = spark.read.parquet(f"{root}/dead_letters").select(
        F.lit("dead letter").alias("side"), "offset", "partition", "ticker", "error_type", "topic", "queue", "first_failed_us"
    )
    return valid.unionByName(dead, allowMissingColumns=True)


@query(
    sql(
        "ticks",
        f"""SELECT ticker, ts_us, seq, price, size, coalesce(ts_us < mark, false) AS late
FROM (SELECT *, max(newest) OVER (ORDER BY slice RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 10000000 AS mark
      FROM (SELECT *, max(ts_us) OVER (PARTITION BY slice) AS newest
            FROM (SELECT *, least((ts_us - {src.EPOCH_US}) // {SLICE_US} + CASE WHEN seq % 20 = 0 THEN 2 ELSE 0 END, {SLICES - 1}) AS slice FROM ticks)))""",
    )
)
def stream_late(spark, d):
    """Every twentieth tick arrives two slices after its time: rows on time and late rows are all rows."""
    t = src.ticks(spark, d)
    slice_of = F.floor((F.col("ts_us") - src.EPOCH_US) / SLICE_US) + F.when(F.col("seq") % 20 == 0, 2).otherwise(0)
    root = shared_folder(spark, "stream_late")
    streams.start_late_split(arriving(t, "ticks", slice_of), root, f"{root}/checkpoint", trigger=ONCE).awaitTermination()
    parts = [
        spark.read.schema(t.schema).option("recursiveFileLookup", True).parquet(f"{root}/{side}").withColumn("late", F.lit(side == "late"))
        for side in ("on_time", "late")
    ]
    return parts[0].unionByName(parts[1])


@query(scored_sql())
def stream_anomaly(spark, d):
    """Scores of a feature stream with held forests."""
    e = streams.enrich(tick_stream(spark, d))
    f = e.select(
        *anomaly.ID,
        "price",
        F.col("size").cast("double").alias("volume"),
        "vwap_1min",
        "volume_zscore",
        "momentum",
        F.lit(0.0).alias("bid_ask_spread"),
        F.col("trade_count_60s").cast("double").alias("trade_frequency"),
    )
    return streams.run_once(streams.anomalies(f), "stream_anomaly").drop(*anomaly.FEATURES_7D)


@query(
    sql(
        "ticks",
        """SELECT ticker, price, size, ts_us, seq, strftime(make_timestamp(ts_us), '%Y') AS year, strftime(make_timestamp(ts_us), '%m') AS month,
       strftime(make_timestamp(ts_us), '%d') AS day, strftime(make_timestamp(ts_us), '%H') AS hour FROM ticks""",
    )
)
def stream_archive(spark, d):
    """Archived rows of a tick stream with their folders."""
    root = shared_folder(spark, "stream_archive")
    t = arriving(src.ticks(spark, d), "ticks")
    streams.start_archive(t, f"{root}/data", f"{root}/checkpoint", trigger=ONCE).awaitTermination()
    return readers.archive(spark, f"{root}/data", schemas.TICK)


@query(sql("ticks", "SELECT ticker || '#' || (seq % 8) AS pk, ticker, ts_us, seq, price, size FROM ticks"))
def stream_insert_if_absent(spark, d):
    """Trades of a stream put into a keyed table; each comes twice, every third once more in a later slice."""
    root = shared_folder(spark, "stream_insert")
    t = src.ticks(spark, d)
    again = F.when(F.col("seq") % 3 == 0, F.array(F.lit(0), F.lit(0), F.lit(2))).otherwise(F.array(F.lit(0), F.lit(0)))
    sent = t.select("*", F.posexplode(again).alias("copy", "later"))
    slice_of = F.floor((F.col("ts_us") - src.EPOCH_US) / SLICE_US) + F.col("later")
    streams.start_insert_if_absent(
        arriving(sent, "trades", slice_of), f"{root}/data", f"{root}/checkpoint", ["ticker", "ts_us", "seq"], ["copy"], trigger=ONCE
    ).awaitTermination()
    return spark.read.parquet(f"{root}/data").select(rules.sequence_shard_key().alias("pk"), *t.columns)
