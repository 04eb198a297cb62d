"""The given star-schema tables seen as market data.

Event types stand for tickers, document texts for news, orders for daily bars. Event
time is squeezed 100 times so that minute windows are populated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.rules import iso_time

# Fixed values of the mapping.
EPOCH_US = 1_704_067_200_000_000  # 2024-01-01T00:00:00Z
SQUEEZE = 100
SPAN_S = 25_920
EVENT_TICKERS = {"view": "VIEW", "click": "CLICK", "error": "ERROR", "signup": "SIGNU", "purchase": "PURCH"}
TICKERS = list(EVENT_TICKERS.values())
LEXICON = [
    ("that", 1500, "word"),
    ("was", -1200, "word"),
    ("with", 800, "word"),
    ("from", -900, "word"),
    ("is", 0, "negator"),
    ("by", 0, "booster"),
    ("for", 0, "dampener"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticker_of(event_type: str) -> Column:
    """The ticker that stands for an event type; an unknown type is an error."""
    known = F.create_map(*[F.lit(x) for kv in EVENT_TICKERS.items() for x in kv])
    ticker = F.element_at(known, F.lower(event_type))
    unknown = F.raise_error(F.concat(F.lit("no ticker for event type "), F.col(event_type))).cast("string")
    return F.when(ticker.isNotNull() | F.col(event_type).isNull(), ticker).otherwise(unknown)


def ticks_of(events: DataFrame, *more: str) -> DataFrame:
    """ticker, price, size, ts_us, seq, k from an events frame (batch or stream)."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return events.select(
        ticker_of("event_type").alias("ticker"),
        (F.lit(50.0) + F.lit(0.25) * k).alias("price"),
        F.floor("value").cast("bigint").alias("size"),
        (F.lit(EPOCH_US) + F.floor((us - EPOCH_US) / SQUEEZE).cast("bigint")).alias("ts_us"),
        F.col("event_id").alias("seq"),
        k.alias("k"),
        *more,
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_of(table(spark, sf_dir, "events")).drop("k")


def ticks_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_json_of(ticks(spark, sf_dir))


def ticks_json_of(t: DataFrame) -> DataFrame:
    """raw, seq, ts_us: one JSON message per tick, every 50th broken in one of five ways."""
    broken = F.when(F.col("seq") % 50 == 0, F.floor(F.col("seq") / 50) % 5)
    body = F.to_json(
        F.struct(
            F.when(broken == 1, F.lower("ticker")).otherwise(F.col("ticker")).alias("ticker"),
            F.when(broken == 0, -F.col("price")).otherwise(F.col("price")).alias("price"),
            F.col("size").alias("volume"),
            F.when(broken == 2, F.lit("yesterday")).otherwise(iso_time("ts_us")).alias("timestamp"),
            F.when(broken == 3, F.lit("halt")).otherwise(F.lit("trade")).alias("event_type"),
            F.col("seq").alias("sequence_number"),
        )
    )
    cut = F.expr("substring(_body, 1, length(_body) - 7)")
    return t.withColumn("_body", body).select(
        F.when(broken == 4, cut).otherwise(F.col("_body")).alias("raw"), "seq", "ts_us"
    )


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh tick as a two-sided quote, some without a bid."""
    t = ticks_of(table(spark, sf_dir, "events")).filter(F.col("seq") % 7 == 0)
    bid = F.col("price") - F.lit(0.01) * (F.col("seq") % 5)
    return t.select(
        "ticker",
        F.when(F.col("seq") % 35 == 0, F.lit(0.0)).otherwise(bid).alias("bid_price"),
        (F.col("price") + F.lit(0.01) * (F.col("seq") % 3)).alias("ask_price"),
        F.col("k").alias("bid_size"),
        (F.lit(99) - F.col("k")).alias("ask_size"),
        "ts_us",
        "seq",
    )


def ticker_at(n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(t) for t in TICKERS]), (n % 5 + 1).cast("int"))


def news_of(documents: DataFrame) -> DataFrame:
    """id, ticker, headline, summary, source, ts_us from a documents frame."""
    d = F.col("doc_id")
    return documents.select(
        d.alias("id"),
        ticker_at(d).alias("ticker"),
        F.substring("text", 1, 120).alias("headline"),
        F.expr("substring(text, 121)").alias("summary"),
        "source",
        (F.lit(EPOCH_US) + (d * 7919 % SPAN_S) * 1_000_000).alias("ts_us"),
    )


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return news_of(table(spark, sf_dir, "documents"))


def lexicon(spark: SparkSession) -> DataFrame:
    """A tiny made-up lexicon for the invented prose; valences in thousandths."""
    return spark.createDataFrame(LEXICON, "token string, valence bigint, role string")


def bars_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars with d/m/y dates and volume 0 on every tenth day, as in raw CSV files."""
    o = table(spark, sf_dir, "orders").withColumn("_d", F.to_date("o_orderdate"))
    volume = F.when(F.dayofmonth("_d") % 10 == 0, F.lit(0)).otherwise(F.count("*"))
    return (
        o.groupBy(F.col("o_orderpriority").alias("index"), "_d")
        .agg(
            F.min_by("o_totalprice", "o_orderkey").alias("open"),
            F.max("o_totalprice").alias("high"),
            F.min("o_totalprice").alias("low"),
            F.max_by("o_totalprice", "o_orderkey").alias("close"),
            volume.cast("bigint").alias("volume"),
        )
        .select(
            "index",
            F.date_format("_d", "dd/MM/yy").alias("date"),
            "open",
            "high",
            "low",
            "close",
            F.col("close").alias("adj_close"),
            "volume",
            (F.col("close") * 0.5).alias("close_usd"),
        )
    )


def write_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One write per event: ts_us, seq, key, latency_ms."""
    t = ticks_of(table(spark, sf_dir, "events"), "value")
    return t.select("ts_us", "seq", F.col("ticker").alias("key"), (F.col("value") * 2).alias("latency_ms"))


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One read request per event: ts_us, seq, path, status, latency_ms."""
    t = ticks_of(table(spark, sf_dir, "events"), "value")
    roots = ["/quotes/", "/aggregations/", "/anomalies/", "/features/", "/sentiment/", "/quote/"]
    root = F.element_at(F.array(*[F.lit(r) for r in roots]), (F.col("seq") % 6 + 1).cast("int"))
    path = (
        F.when(F.col("seq") % 11 == 0, "/market-prices")
        .when(F.col("seq") % 13 == 0, "/static/app.js")
        .otherwise(F.concat(root, F.lower("ticker")))
    )
    status = F.when(F.col("seq") % 97 == 0, 500).when(F.col("seq") % 41 == 0, 404).otherwise(200)
    return t.select(
        "ts_us",
        "seq",
        path.alias("path"),
        status.cast("bigint").alias("status"),
        (F.col("value") * 2).alias("latency_ms"),
    )


def offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A consumer-group offsets table: one topic per order status, one partition per priority."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(
        F.col("o_orderstatus").alias("topic"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("partition"),
    ).agg(
        F.min("o_orderkey").alias("low"),
        F.max("o_orderkey").alias("high"),
        F.max(
            F.when((F.col("o_custkey") % 4 == 0) & ~F.col("o_orderpriority").startswith("5"), F.col("o_orderkey"))
        ).alias("committed"),
    )
