"""Reading, checking, normalising and deduplicating records."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import rules
from tickloom.operators import deadletter, keyed, normalize, validate
from tickloom.plans.catalogue import query
from tickloom.plans.views import sql
from tickloom.sources import adapters as src

_BROKEN = """CASE WHEN seq % 50 <> 0 THEN NULL
     ELSE ['price', 'ticker', 'timestamp', 'event_type', 'json'][(seq // 50) % 5 + 1] END"""


@query(
    sql(
        "ticks",
        f"""SELECT ticker, price, size AS volume, ts_us, 'trade' AS event_type, seq AS sequence_number
FROM ticks WHERE {_BROKEN} IS NULL AND seq % 33 <> 0""",
    )
)
def trades_from_events(spark, d):
    """Message bytes to checked trades; some values are not UTF-8 and are skipped."""
    m = src.ticks_json(spark, d).select(
        F.when(F.col("seq") % 33 == 0, F.concat(F.unhex(F.lit("FFFE")), F.encode("raw", "UTF-8")))
        .otherwise(F.encode("raw", "UTF-8"))
        .alias("value")
    )
    return validate.valid_only(validate.market_events(validate.decode_messages(m))).drop("raw")


def _news_json(spark, d):
    """raw, id, ts_us: one JSON message per article; every twentieth is cut short, and the
    one after it has no ticker."""
    body = F.to_json(
        F.struct(
            F.col("id").cast("string").alias("article_id"),
            F.when(F.col("id") % 20 != 1, F.col("ticker")).alias("ticker"),
            "headline",
            "summary",
            "source",
            rules.iso_time().alias("published_at"),
        )
    )
    raw = F.when(F.col("id") % 20 == 0, F.expr("substring(b, 1, length(b) - 3)")).otherwise(F.col("b"))
    return src.news(spark, d).withColumn("b", body).select(raw.alias("raw"), "id", "ts_us")


@query(sql("news", "SELECT id, ticker, headline, summary, source, ts_us FROM news WHERE id % 20 NOT IN (0, 1)"))
def news_from_documents(spark, d):
    """News messages as JSON, some broken, back to rows."""
    n = validate.news_messages(_news_json(spark, d).select("raw"))
    return n.withColumn("id", F.col("id").cast("bigint"))


@query(
    sql(
        "news",
        """SELECT id AS "offset", CASE id % 20 WHEN 0 THEN 'JsonError' ELSE 'ValidationError' END AS error_type,
       CASE id % 20 WHEN 0 THEN 'message is not JSON' ELSE 'message has no ticker' END AS error_reason, 'market.news' AS topic,
       'unknown' AS ticker, 0::INT AS retry_count, ts_us + 1000000 AS first_failed_us, 'main' AS queue
FROM news WHERE id % 20 IN (0, 1)""",
    )
)
def news_dead_letters(spark, d):
    """Failed news messages as queued, read back from their JSON bodies."""
    m = _news_json(spark, d).withColumnsRenamed({"id": "at", "ts_us": "sent_us"})
    letters = deadletter.dead_letters(
        validate.invalid_only(validate.news_events(m)),
        failed_us=F.col("sent_us") + 1_000_000,
        topic="market.news",
        offset=F.col("at"),
        queue="main",
    )
    queued = deadletter.attributes(letters).withColumnRenamed("ticker", "queued_ticker").drop("error_type")
    return deadletter.read_bodies(queued).select(
        "offset", "error_type", "error_reason", "topic", F.col("queued_ticker").alias("ticker"),
        "retry_count", "first_failed_us", "queue",
    )


def _checked(spark, d):
    return validate.market_events(src.ticks_json(spark, d), at="event_us")


@query(
    sql(
        "ticks",
        f"SELECT seq, ticker, price, size AS volume, ts_us, 'trade' AS event_type FROM ticks WHERE {_BROKEN} IS NULL",
    )
)
def validate_market(spark, d):
    return validate.valid_only(_checked(spark, d)).select(
        "seq", "ticker", "price", "volume", F.col("event_us").alias("ts_us"), "event_type"
    )


@query(
    sql("ticks", f"SELECT seq, field AS error_field FROM (SELECT seq, {_BROKEN} AS field FROM ticks) WHERE field IS NOT NULL")
)
def validate_market_errors(spark, d):
    return validate.invalid_only(_checked(spark, d)).select("seq", "error_field")


@query(sql("ticks", f"SELECT coalesce({_BROKEN}, 'valid') AS outcome, count(*) AS n FROM ticks GROUP BY 1"))
def validation_counts(spark, d):
    return validate.outcome_counts(_checked(spark, d))


def _raw_trades(spark, d):
    s = F.col("seq")
    return src.ticks(spark, d).select(
        F.when(s % 3 == 0, F.concat(F.lit(" "), F.lower("ticker"), F.lit(" "))).otherwise(F.col("ticker")).alias("ticker"),
        F.when(s % 29 == 0, -F.col("price")).otherwise(F.col("price")).alias("price"),
        "size",
        F.when(s % 10 != 0, F.col("ts_us")).alias("ts_us"),
        (F.col("ts_us") + 250_000).alias("received_us"),
        "seq",
    )


@query(
    sql(
        "ticks",
        """SELECT ticker, CASE WHEN seq % 29 = 0 THEN -price ELSE price END AS price, size,
       CASE WHEN seq % 10 = 0 THEN ts_us + 250000 ELSE ts_us END AS ts_us, seq, size >= 1 AND seq % 29 <> 0 AS valid
FROM ticks""",
    )
)
def validate_trade(spark, d):
    return validate.trades(_raw_trades(spark, d), "received_us").drop("received_us")


@query(
    sql(
        "quotes",
        """SELECT ticker, CASE WHEN seq % 3 = 0 THEN -bid_price - 1 ELSE bid_price END AS bid_price, ask_price,
       CASE WHEN seq % 4 = 0 THEN 0 ELSE bid_size END AS bid_size,
       CASE WHEN seq % 5 = 0 THEN -1 ELSE ask_size END::BIGINT AS ask_size, ts_us, seq,
       seq % 3 <> 0 AND seq % 5 <> 0 AS valid
FROM quotes""",
    )
)
def validate_quote(spark, d):
    s = F.col("seq")
    q = (
        src.quotes(spark, d)
        .withColumn("bid_price", F.when(s % 3 == 0, -F.col("bid_price") - 1).otherwise(F.col("bid_price")))
        .withColumn("bid_size", F.when(s % 4 != 0, F.col("bid_size")))
        .withColumn("ask_size", F.when(s % 5 == 0, F.lit(-1)).otherwise(F.col("ask_size")).cast("bigint"))
    )
    return validate.quotes(q)


@query(
    sql(
        "news",
        """SELECT CASE WHEN id % 9 <> 0 THEN id END AS id, ticker,
       CASE WHEN id % 7 = 0 THEN '' ELSE trim(headline, ' ') END AS headline, ts_us,
       id % 9 <> 0 AND id % 7 <> 0 AND length(trim(headline, ' ')) >= 1 AS valid
FROM news""",
    )
)
def validate_news(spark, d):
    i = F.col("id")
    n = src.news(spark, d).select(
        F.when(i % 9 == 0, F.lit("n/a")).otherwise(i.cast("string")).alias("id"),
        F.lower("ticker").alias("ticker"),
        F.when(i % 7 == 0, F.lit("   ")).otherwise(F.col("headline")).alias("headline"),
        "ts_us",
    )
    return validate.news(n)


def mixed_ticks(spark, d):
    """Trades with every seventh tick a quote instead, as one raw wide frame."""
    t = src.ticks(spark, d).filter(F.col("seq") % 7 != 0)
    return t.unionByName(src.quotes(spark, d), allowMissingColumns=True).select(
        "*", F.lit(None).cast("string").alias("trade_id"), F.col("seq").alias("sequence")
    )


MIXED_SQL = """mixed AS (
  SELECT ticker, price, size, 0.0::DOUBLE AS spread, ts_us, seq, CASE WHEN size >= 1 THEN 'trade' ELSE 'dlq' END AS kind,
         seq::VARCHAR AS event_id
  FROM ticks WHERE seq % 7 <> 0
  UNION ALL
  SELECT ticker, CASE WHEN bid_price > 0 AND ask_price > 0 THEN (bid_price + ask_price) / 2.0 ELSE greatest(bid_price, ask_price, 1e-6) END,
         greatest(bid_size, ask_size, 1), CASE WHEN bid_price > 0 AND ask_price > 0 THEN greatest(ask_price - bid_price, 0.0) ELSE 0.0 END,
         ts_us, seq, 'quote', NULL
  FROM quotes)"""


@query(sql("quotes", f"WITH {MIXED_SQL} SELECT ticker, price, size, spread, ts_us, seq, kind FROM mixed"))
def dispatch_ticks(spark, d):
    return validate.dispatch(mixed_ticks(spark, d)).select(
        "ticker", "price", "size", "spread", "ts_us", "seq", "kind"
    )


@query(
    sql(
        "quotes",
        f"WITH {MIXED_SQL} SELECT seq, price AS mid, size, spread FROM mixed WHERE kind = 'quote'",
    )
)
def quote_mid_spread(spark, d):
    return src.quotes(spark, d).select(
        "seq",
        rules.quote_mid().alias("mid"),
        rules.quote_size().alias("size"),
        rules.quote_spread().alias("spread"),
    )


@query(
    sql(
        "ticks",
        """SELECT seq, CASE WHEN seq % 3 = 0 THEN 'T-' || seq WHEN seq % 3 = 1 THEN seq::VARCHAR
       ELSE sha256(ticker || '|' || ts_us || '|' || size) END AS event_id FROM ticks""",
    )
)
def event_ids(spark, d):
    s = F.col("seq")
    t = src.ticks(spark, d).select(
        "*",
        F.when(s % 3 == 0, F.concat(F.lit("T-"), s.cast("string"))).alias("trade_id"),
        F.when(s % 3 == 1, s).alias("sequence"),
    )
    return t.select("seq", rules.trade_event_id(content=("ticker", "ts_us", "size")).alias("event_id"))


@query(
    sql(
        "ticks",
        """SELECT ticker, CASE WHEN seq % 17 = 0 THEN 0.0 ELSE price END AS price, CASE WHEN seq % 19 = 0 THEN 0 ELSE size END AS size,
       CASE WHEN seq % 23 = 0 THEN ts_us + 1000000 ELSE ts_us END AS ts_us, (seq % 12)::VARCHAR AS exchange,
       'X' || seq AS trade_id, CASE WHEN seq % 4 = 0 THEN NULL ELSE k || ',' || (k + 1) END AS conditions, seq AS sequence
FROM ticks""",
    )
)
def normalize_vendor(spark, d):
    s = F.col("seq")
    v = src.ticks_of(src.table(spark, d, "events")).select(
        F.concat(F.lower("ticker"), F.lit(" ")).alias("symbol"),
        F.when(s % 17 != 0, F.col("price")).alias("price"),
        F.when(s % 19 != 0, F.col("size")).alias("size"),
        F.when(s % 23 != 0, F.col("ts_us") * 1000 + 7).alias("timestamp"),
        (s % 12).alias("exchange"),
        F.concat(F.lit("X"), s.cast("string")).alias("id"),
        F.when(s % 4 != 0, F.array("k", F.col("k") + 1)).otherwise(F.array().cast("array<bigint>")).alias("conditions"),
        s.alias("sequence_number"),
        (F.col("ts_us") + 1_000_000).alias("received_us"),
    )
    out = normalize.vendor_trades(v, "received_us")
    return out.withColumn("conditions", F.array_join("conditions", ","))


@query(
    sql(
        "quotes",
        """SELECT ticker, CASE WHEN seq % 5 = 0 THEN 0.0 ELSE bid_price END AS bid_price, ask_price, bid_size,
       CASE WHEN seq % 2 = 0 THEN 0 ELSE ask_size END AS ask_size, ts_us FROM quotes""",
    )
)
def normalize_vendor_quotes(spark, d):
    s = F.col("seq")
    v = src.quotes(spark, d).select(
        F.concat(F.lit(" "), F.lower("ticker")).alias("symbol"),
        F.when(s % 5 != 0, F.col("bid_price")).alias("bid_price"),
        "ask_price",
        "bid_size",
        F.when(s % 2 != 0, F.col("ask_size")).alias("ask_size"),
        (F.col("ts_us") * 1000 + 999).alias("timestamp"),
    )
    return normalize.vendor_quotes(v)


@query(
    sql(
        "ticks",
        """SELECT seq, ticker, price, size AS volume, CASE WHEN seq % 5 = 0 THEN 'quote' ELSE 'trade' END AS event_type
FROM ticks WHERE seq % 31 <> 0 AND seq % 37 <> 0""",
    )
)
def normalize_alt_names(spark, d):
    s, long = F.col("seq"), F.col("seq") % 2 == 0
    t = src.ticks(spark, d)
    name = F.when(s % 31 != 0, F.col("ticker"))
    price = F.when(s % 37 != 0, F.col("price")).otherwise(F.lit(-1.0))
    v = t.select(
        "seq",
        F.when(long, name).alias("symbol"),
        F.when(~long, name).alias("sym"),
        F.when(long, price).otherwise(F.lit(0.0)).alias("price"),
        F.when(~long, price).alias("p"),
        F.when(long, F.col("size")).alias("size"),
        F.when(~long, F.col("size")).alias("s"),
        F.when(s % 5 == 0, F.col("price")).alias("ask"),
        F.when(s % 10 == 0, F.col("price")).alias("bid"),
    )
    return normalize.short_named(v)


@query(
    sql(
        "news",
        """SELECT id, ticker, trim(headline, ' ') AS headline, source,
       CASE WHEN id % 4 = 3 THEN ts_us + 5 ELSE ts_us END AS ts_us
FROM news WHERE id % 13 <> 0 AND id % 11 <> 0 AND trim(headline, ' ') <> ''""",
    )
)
def normalize_news(spark, d):
    i = F.col("id")
    time = (
        F.when(i % 4 == 3, "soon")
        .when(i % 2 == 0, F.floor(F.col("ts_us") / 1_000_000).cast("string"))
        .otherwise(rules.iso_time())
    )
    a = src.news(spark, d).select(
        F.when(i % 13 == 0, F.lit("abc")).when(i % 26 != 0, i.cast("string")).alias("id"),
        F.lower("ticker").alias("ticker"),
        F.when(i % 11 != 0, F.concat(F.lit("  "), F.col("headline"), F.lit(" "))).alias("headline"),
        "summary",
        F.lit(None).cast("string").alias("url"),
        "source",
        time.alias("datetime"),
        (F.col("ts_us") + 5).alias("received_us"),
    )
    return normalize.articles(a, "received_us").drop("summary", "url")


@query(sql("ticks", "SELECT ticker, ts_us, seq, price FROM ticks WHERE ticker IN ('VIEW', 'ERROR')"))
def ticker_universe(spark, d):
    t = src.ticks(spark, d).select("ticker", "ts_us", "seq", "price")
    allowed = spark.createDataFrame([(x,) for x in normalize.universe(" VIEW ,, ERROR,NONE")], "ticker string")
    return normalize.in_universe(t, allowed)


@query(
    sql(
        "ticks",
        """SELECT seq, ticker || '#' || strftime(make_timestamp(ts_us), '%Y-%m-%d-%H') AS bucket_key FROM ticks""",
    )
)
def hour_bucket_key(spark, d):
    return src.ticks(spark, d).select("seq", rules.hour_bucket_key().alias("bucket_key"))


@query(
    sql(
        "ticks",
        """SELECT seq, ticker || '#' || (('0x' || substr(md5(ticker || '|' || ts_us), 1, 8))::BIGINT % 8) AS pk FROM ticks""",
    )
)
def shard_key(spark, d):
    return src.ticks(spark, d).select("seq", rules.shard_key("ticker", "ts_us").alias("pk"))


@query(
    sql(
        "ticks",
        "SELECT ticker, count(DISTINCT seq % 8) AS shards, count(*) AS n FROM ticks GROUP BY ticker",
    )
)
def shard_spread(spark, d):
    """How many shards each ticker uses; rows are counted per shard first, so no set of rows is built."""
    pk = rules.sequence_shard_key("ticker", "seq").alias("pk")
    per_shard = src.ticks(spark, d).groupBy("ticker", pk).agg(F.count("*").alias("n"))
    return per_shard.groupBy("ticker").agg(F.count("*").alias("shards"), F.sum("n").alias("n"))


@query(
    sql(
        "ticks",
        """SELECT seq, CASE WHEN seq % 14 = 0 THEN NULL ELSE ts_us END AS ts_us,
       CASE WHEN seq % 15 = 0 THEN NULL ELSE seq || '#a' END AS event_id FROM ticks""",
    )
)
def sort_key_parse(spark, d):
    s = F.col("seq")
    time = F.when(s % 14 == 0, "no time").otherwise(rules.iso_time())
    sk = F.when(s % 15 == 0, time).otherwise(F.concat(time, F.lit("#"), s.cast("string"), F.lit("#a")))
    keys = src.ticks(spark, d).select("seq", sk.alias("sk"))
    return normalize.sort_key_parts(keys).drop("sk")


def _feature_maps(spark, d):
    """Maps as different writers store them: names and number formats vary."""
    s = F.col("seq")
    vwap = F.element_at(F.array(*[F.lit(x) for x in ("vwap_5min", "vwap_5m", "vwap_1min", "other")]), (s % 4 + 1).cast("int"))
    mom = F.when(s % 2 == 0, "momentum").otherwise("price_momentum")
    m = F.map_from_arrays(
        F.array(vwap, F.lit("volume_zscore"), mom, F.lit("note")),
        F.array(
            F.col("price").cast("string"),
            F.when(s % 6 == 0, "n/a").otherwise(F.col("size").cast("string")),
            F.lit("0.5"),
            F.lit("text"),
        ),
    )
    return src.ticks(spark, d).select("seq", m.alias("features"))


@query(
    sql(
        "ticks",
        """SELECT seq, CASE WHEN seq % 4 = 3 THEN 0.0 ELSE price END AS vwap_5min,
       CASE WHEN seq % 6 = 0 THEN 0.0 ELSE size::DOUBLE END AS volume_zscore, 0.5::DOUBLE AS price_momentum,
       0.0::DOUBLE AS trade_frequency, NULL::DOUBLE AS bid_ask_spread FROM ticks""",
    )
)
def feature_map_read(spark, d):
    m = _feature_maps(spark, d).withColumn("features", normalize.numeric_map("features"))
    return normalize.read_features(m)


@query(sql("ticks", "SELECT seq, CASE WHEN seq % 6 = 0 THEN 2 ELSE 3 END::BIGINT AS n, price AS first_value FROM ticks"))
def feature_map_coerce(spark, d):
    m = _feature_maps(spark, d).withColumn("features", normalize.numeric_map("features"))
    return m.select(
        "seq", F.size("features").cast("bigint").alias("n"), F.get(F.map_values("features"), 0).alias("first_value")
    )


@query(
    sql(
        "ticks",
        """SELECT seq, ticker, CASE WHEN c <= 0 AND pc > 0 THEN pc ELSE c END AS price,
       CASE WHEN c <= 0 AND pc > 0 THEN 0.0 ELSE d END AS change,
       CASE WHEN c <= 0 AND pc > 0 THEN 0.0 ELSE dp END AS change_pct, pc AS previous_close, h AS high, l AS low, o AS open
FROM (SELECT seq, ticker, CASE WHEN seq % 9 = 0 THEN 0.0 ELSE round(price / 3.0, 2) END AS c,
             CASE WHEN seq % 27 = 0 THEN 0.0 ELSE round(price / 7.0, 2) END AS pc,
             round(price / 3.0 - price / 7.0, 2) AS d, round(price / 13.0, 2) AS dp, round(price / 2.9, 2) AS h,
             round(price / 7.1, 2) AS l, round(price / 6.1, 2) AS o FROM ticks)
WHERE CASE WHEN c <= 0 AND pc > 0 THEN pc ELSE c END > 0""",
    )
)
def snapshot_quote(spark, d):
    s, p = F.col("seq"), F.col("price")
    v = src.ticks(spark, d).select(
        "seq",
        "ticker",
        F.when(s % 9 != 0, p / 3.0).alias("c"),
        F.when(s % 27 != 0, p / 7.0).alias("pc"),
        (p / 3.0 - p / 7.0).alias("d"),
        (p / 13.0).alias("dp"),
        (p / 2.9).alias("h"),
        (p / 7.1).alias("l"),
        (p / 6.1).alias("o"),
    )
    return normalize.snapshot_quotes(v)


@query(
    sql(
        "ticks",
        """SELECT ticker || '#' || (seq % 8) AS pk, strftime(make_timestamp(ts_us), '%Y-%m-%dT%H:%M:%S.%fZ') || '#' || seq AS sk,
       ticker, strftime(make_timestamp(ts_us), '%Y-%m-%dT%H:%M:%S.%fZ') AS ts, ts_us // 1000000 + 172800 AS ttl,
       price::VARCHAR AS price, size FROM ticks""",
    )
)
def keyed_items(spark, d):
    t = src.ticks(spark, d).withColumn("price", F.col("price").cast("string"))
    return normalize.keyed_items(t, "trades", "seq", "price", "size")


@query(
    sql(
        "news",
        """SELECT ticker AS pk, strftime(make_timestamp(ts_us), '%Y-%m-%dT%H:%M:%S.%fZ') || '#' || id AS sk, ticker,
       strftime(make_timestamp(ts_us), '%Y-%m-%dT%H:%M:%S.%fZ') AS ts, ts_us // 1000000 + 2592000 AS ttl, headline FROM news""",
    )
)
def keyed_news_items(spark, d):
    return normalize.keyed_items(src.news(spark, d), "sentiment", "id", "headline", sharded=False)


@query(
    sql(
        "requests",
        """SELECT seq, path, CASE WHEN regexp_matches(path, '^/(quotes|aggregations|anomalies|features|sentiment)/')
            THEN upper(split_part(path, '/', 3)) END AS ticker,
       path = '/market-prices' OR path LIKE '/quote/%' OR path LIKE '/sentiment/%' AS is_external,
       path LIKE '/static%' AS is_static FROM requests""",
    )
)
def request_log(spark, d):
    r = normalize.request_details(src.request_log(spark, d))
    return r.select("seq", "path", "ticker", "is_external", "is_static")


@query(
    sql(
        "news",
        """SELECT id, ticker, headline, ts_us FROM news""",
    )
)
def news_dedup(spark, d):
    """Articles polled for several tickers and several times; the first sighting stays."""
    n = src.news(spark, d).select("id", "ticker", "headline", "ts_us")
    again = n.filter(F.col("id") % 3 == 0).withColumn("ts_us", F.col("ts_us") + 60_000_000)
    other = n.filter(F.col("id") % 4 == 0).withColumn("ticker", F.lit("ZZZ"))
    polled = n.unionByName(again).unionByName(other)
    return keyed.keep_first(polled, ["id"], ["ts_us", "ticker"])


@query(
    sql(
        "news",
        """SELECT id, ticker, headline, ts_us FROM news UNION ALL SELECT id, 'ZZZ', headline, ts_us FROM news WHERE id % 4 = 0""",
    )
)
def news_dedup_per_ticker(spark, d):
    """The same with one copy kept per ticker."""
    n = src.news(spark, d).select("id", "ticker", "headline", "ts_us")
    again = n.filter(F.col("id") % 3 == 0).withColumn("ts_us", F.col("ts_us") + 60_000_000)
    other = n.filter(F.col("id") % 4 == 0).withColumn("ticker", F.lit("ZZZ"))
    polled = n.unionByName(again).unionByName(other)
    return keyed.keep_first(polled, ["id", "ticker"], ["ts_us"])


@query(sql("ticks", "SELECT ticker, ts_us, seq, price, size FROM ticks"))
def trade_dedup(spark, d):
    t = src.ticks(spark, d).select("ticker", "ts_us", "seq", "price", "size")
    replayed = t.unionByName(t.filter(F.col("seq") % 5 == 0)).unionByName(t.filter(F.col("seq") % 3 == 0))
    return keyed.keep_first(replayed, ["ticker", "ts_us", "seq"], ["price", "size"])


@query(sql("quotes", f"WITH {MIXED_SQL} SELECT kind, count(*) AS n, sum(size)::BIGINT AS volume FROM mixed GROUP BY kind"))
def dispatch_counts(spark, d):
    """Mixed JSON ticks parsed and routed."""
    m = mixed_ticks(spark, d).withColumn("timestamp", rules.iso_time())
    body = F.to_json(F.struct(*[c for c in m.columns if c not in ("ts_us", "seq")]))
    parsed = validate.tick_messages(m.select(body.alias("raw")))
    return validate.dispatch(parsed).groupBy("kind").agg(F.count("*").alias("n"), F.sum("size").alias("volume"))
