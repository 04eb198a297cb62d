"""What the sinks write, and what is read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tickloom.functions import rules
from tickloom.operators import deadletter, keyed, rolling, validate
from tickloom.plans.catalogue import query
from tickloom.plans.views import sql
from tickloom.session import shared_folder
from tickloom.sources import adapters as src
from tickloom.sources import readers, schemas, sinks

def _name(prefix: str) -> str:
    """A fresh name in the catalogue."""
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


_BROKEN = "['price', 'ticker', 'timestamp', 'event_type', 'json'][(seq // 50) % 5 + 1]"
_DATED = """strftime(make_timestamp(ts_us), '%Y') AS year, strftime(make_timestamp(ts_us), '%m') AS month,
       strftime(make_timestamp(ts_us), '%d') AS day, strftime(make_timestamp(ts_us), '%H') AS hour"""


@query(sql("ticks", f"SELECT ticker, price, size, ts_us, seq, {_DATED} FROM ticks"))
def archive_rows(spark, d):
    """Ticks after a round trip through the Parquet archive."""
    root = shared_folder(spark, "archive")
    sinks.write_archive(src.ticks(spark, d), root)
    return readers.archive(spark, root, schemas.TICK)


@query(sql("ticks", f"SELECT * FROM (SELECT ticker, price, size, ts_us, seq, {_DATED} FROM ticks) WHERE hour = '03'"))
def archive_scan_hour(spark, d):
    """One hour of the archive; the other folders are not read."""
    root = shared_folder(spark, "archive")
    sinks.write_archive(src.ticks(spark, d), root)
    return readers.archive(spark, root, schemas.TICK, hour="03")


@query(sql("ticks", f"SELECT year, month, day, hour, count(*) AS n FROM (SELECT {_DATED} FROM ticks) GROUP BY ALL"))
def archive_partitions(spark, d):
    """Rows per hour of an archive that is a table of the catalogue."""
    root, table = shared_folder(spark, "archive"), _name("archive")
    sinks.write_archive(src.ticks(spark, d), root)
    sinks.register(spark, table, root, schemas.TICK)
    listed = spark.sql(f"SHOW PARTITIONS {table}").select(
        *[F.regexp_extract("partition", f"{p}=([^/]+)", 1).alias(p) for p in sinks.HOUR_PARTS]
    )
    return listed.join(spark.table(table).groupBy(*sinks.HOUR_PARTS).agg(F.count("*").alias("n")), sinks.HOUR_PARTS, "left")


@query(sql("ticks", "SELECT ticker, ts_us, seq, price, size FROM ticks WHERE seq % 3 <> 0"))
def insert_if_absent_trades(spark, d):
    """Replayed trades against a table that already holds every third of them."""
    t = src.ticks(spark, d).select("ticker", "ts_us", "seq", "price", "size")
    replayed = t.unionByName(t.filter(F.col("seq") % 4 == 0))
    return keyed.insert_if_absent(replayed, t.filter(F.col("seq") % 3 == 0), ["ticker", "ts_us", "seq"], ["price"])


@query(sql("news", "SELECT ticker, id, ts_us, headline FROM news WHERE id % 6 <> 0"))
def insert_if_absent_news(spark, d):
    n = src.news(spark, d).select("ticker", "id", "ts_us", "headline")
    return keyed.insert_if_absent(n, n.filter(F.col("id") % 6 == 0), ["ticker", "id"], ["ts_us"])


@query(
    sql(
        "ticks",
        """SELECT ticker, ts_us, seq, CASE WHEN seq % 4 = 0 THEN price + 2 WHEN seq % 2 = 0 THEN price + 1 ELSE price END AS price,
       CASE WHEN seq % 4 = 0 THEN 2 WHEN seq % 2 = 0 THEN 1 ELSE 0 END::BIGINT AS version FROM ticks""",
    )
)
def upsert_latest(spark, d):
    t = src.ticks(spark, d).select("ticker", "ts_us", "seq", "price")

    def put(step: int, version: int):
        return t.filter(F.col("seq") % step == 0).select(
            "ticker", "ts_us", "seq", (F.col("price") + version).alias("price"), F.lit(version).cast("bigint").alias("version")
        )

    return keyed.upsert(put(1, 0).unionByName(put(2, 1)), put(4, 2), ["ticker", "ts_us", "seq"], ["version"])


@query(
    sql(
        "ticks",
        """SELECT ticker, ts_us, seq, CASE WHEN seq % 5 = 0 THEN price + 1 ELSE price END AS price,
       CASE WHEN seq % 5 = 0 THEN 2 ELSE 1 END::INTEGER AS version FROM ticks""",
    )
)
def upsert_table(spark, d):
    """Two bulk puts into a table of days, and its rows afterwards."""
    root, table = shared_folder(spark, "quotes"), _name("quotes")
    t = src.ticks(spark, d).select("ticker", "ts_us", "seq", "price").withColumn("version", F.lit(1))
    sinks.upsert(t, table, root, ["ticker", "ts_us", "seq"], ["version"])
    again = t.filter(F.col("seq") % 5 == 0).withColumn("price", F.col("price") + 1).withColumn("version", F.lit(2))
    sinks.upsert(again, table, root, ["ticker", "ts_us", "seq"], ["version"])
    return spark.table(table).drop(*sinks.DAY_PARTS)


@query(sql("ticks", "SELECT ticker, count(*) AS n, count(DISTINCT seq) AS distinct_n FROM ticks GROUP BY ticker"))
def append_new_table(spark, d):
    """The same trades appended twice, as a replay does."""
    root = shared_folder(spark, "trades")
    t = src.ticks(spark, d)
    for batch in (t.filter(F.col("seq") % 2 == 0), t):
        sinks.append_new(batch, root, ["ticker", "ts_us", "seq"], ["price"])
    per_row = spark.read.parquet(root).groupBy("ticker", "seq").agg(F.count("*").alias("_n"))
    return per_row.groupBy("ticker").agg(F.sum("_n").alias("n"), F.count("*").alias("distinct_n"))


@query(
    sql(
        "enriched",
        """SELECT ticker || '#' || strftime(make_timestamp(ts_us), '%Y-%m-%d-%H') AS pk, ts_us, price, size::DOUBLE AS volume,
       vwap_5min, volume_zscore, momentum, trade_count_60s::DOUBLE AS trade_frequency, ts_us // 1000000 + 604800 AS ttl,
       seq, CASE WHEN seq % 3 = 1 THEN 1 ELSE 2 END::INTEGER AS version FROM enriched""",
    )
)
def feature_rows(spark, d):
    """Feature maps put under their hour key twice, shown as columns: a third of the rows
    comes right at once, the others with a price of 0 at first, and both again."""
    e = rolling.enrich(src.ticks(spark, d))
    names = ["price", "volume", "vwap_5min", "volume_zscore", "momentum", "trade_frequency"]
    values = ["price", "size", "vwap_5min", "volume_zscore", "momentum", "trade_count_60s"]
    m = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col(v).cast("double") for v in values]))
    root, table = shared_folder(spark, "features"), _name("features")
    right = F.col("seq") % 3 == 1
    for version in (1, 2):
        stale = F.map_concat(F.map_filter("features", lambda k, _: k != "price"), F.create_map(F.lit("price"), F.lit(0.0)))
        rows = e.select(
            rules.hour_bucket_key().alias("pk"),
            "ts_us",
            "seq",
            m.alias("features"),
            rules.expires_at("features").alias("ttl"),
            F.when(right, 1).otherwise(version).alias("version"),
        )
        if version == 1:
            rows = rows.withColumn("features", F.when(right, F.col("features")).otherwise(stale))
        sinks.upsert(rows, table, root, ["pk", "ts_us", "seq"], ["version"])
    return spark.table(table).select("pk", "ts_us", *[F.element_at("features", n).alias(n) for n in names], "ttl", "seq", "version")


# A broken message as text, and its dead letter.
_LETTER_TICKER = "CASE WHEN f = 'ticker' THEN lower(ticker) ELSE ticker END"
_LETTERS = f"""(SELECT *, '{{"ticker":"' || {_LETTER_TICKER} || '","price":' || (CASE WHEN f = 'price' THEN -price ELSE price END)::VARCHAR
         || ',"volume":' || size || ',"timestamp":"' || CASE WHEN f = 'timestamp' THEN 'yesterday' ELSE strftime(make_timestamp(ts_us), '%Y-%m-%dT%H:%M:%S.%fZ') END
         || '","event_type":"' || CASE WHEN f = 'event_type' THEN 'halt' ELSE 'trade' END || '","sequence_number":' || seq || '}}' AS message
      FROM (SELECT *, {_BROKEN} AS f FROM ticks WHERE seq % 50 = 0))"""
_REASON = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in validate.REASONS.items())
_LETTER = f"""CASE WHEN f = 'json' THEN message[1:length(message) - 7] ELSE message END AS original_message, CASE f {_REASON} END AS error_reason,
       CASE WHEN f = 'json' THEN 'JsonError' ELSE 'ValidationError' END AS error_type, 'market.trades' AS topic, seq AS "offset",
       (seq % 6)::INT AS "partition", CASE WHEN f <> 'json' THEN {_LETTER_TICKER} END AS ticker, 0::INT AS retry_count, ts_us + 1000000 AS first_failed_us,
       ts_us + 1000000 AS last_failed_us, CASE WHEN f = 'json' THEN 'main' ELSE 'validation' END AS queue"""


def _letters(spark, d):
    bad = validate.invalid_only(validate.market_events(src.ticks_json(spark, d), at="event_us"))
    return deadletter.dead_letters(
        bad,
        failed_us=F.col("ts_us") + 1_000_000,
        offset=F.col("seq"),
        partition=F.pmod("seq", F.lit(6)),
        queue=F.when(F.col("error_field") == "json", "main").otherwise("validation"),
    )


@query(
    sql(
        "ticks",
        f"""SELECT {_LETTER} FROM {_LETTERS}""",
    )
)
def dlq_validation(spark, d):
    """Dead letters as stored in the queue folders."""
    root = shared_folder(spark, "dead-letters")
    sinks.write_dead_letters(_letters(spark, d), root)
    return spark.read.schema(schemas.DEAD_LETTER + ", queue string").parquet(root)


@query(
    sql(
        "ticks",
        f"""SELECT queue, error_type, coalesce(ticker, 'unknown') AS ticker,
       '{{"original_message":"' || replace(original_message, '"', '\\"') || '","error_reason":"' || error_reason || '","error_type":"' || error_type
       || '","topic":"' || topic || '","offset":' || "offset" || ',"partition":' || "partition" || coalesce(',"ticker":"' || ticker || '"', '')
       || ',"retry_count":' || retry_count || ',"first_failed_at":"' || strftime(make_timestamp(first_failed_us), '%Y-%m-%dT%H:%M:%S.%fZ')
       || '","last_failed_at":"' || strftime(make_timestamp(last_failed_us), '%Y-%m-%dT%H:%M:%S.%fZ') || '"}}' AS body
FROM (SELECT {_LETTER} FROM {_LETTERS})""",
    )
)
def dlq_attributes(spark, d):
    """Message bodies with the attributes a queue filters on."""
    return deadletter.attributes(_letters(spark, d))


@query(
    sql(
        "ticks",
        """SELECT CASE WHEN (seq // 50) % 5 = 4 THEN 'main' ELSE 'validation' END AS queue, count(*) AS depth
FROM ticks WHERE seq % 50 = 0 GROUP BY ALL""",
    )
)
def dlq_depth(spark, d):
    return deadletter.depth(_letters(spark, d))


@query(
    sql(
        "ticks",
        f"""SELECT {_LETTER}, strftime(make_timestamp(ts_us + 1000000), '%Y') AS year, strftime(make_timestamp(ts_us + 1000000), '%m') AS month,
       strftime(make_timestamp(ts_us + 1000000), '%d') AS day, CASE WHEN f = 'json' THEN 'unknown' ELSE {_LETTER_TICKER} END || '_' || (ts_us + 1000000) // 1000000 AS name
FROM {_LETTERS}""",
    )
)
def dlq_archive(spark, d):
    """Dead letters as read back from their JSON archive by day."""
    root = shared_folder(spark, "dead-archive")
    sinks.archive_dead_letters(_letters(spark, d), root)
    kept = schemas.DEAD_LETTER + ", queue string, name string, year string, month string, day string"
    return spark.read.schema(kept).json(root)


@query(
    sql(
        "ticks",
        """SELECT seq AS "offset", CASE WHEN ok THEN 'done' WHEN rc + 1 >= 3 THEN 'archive' ELSE 'requeue' END AS action,
       (CASE WHEN ok THEN rc ELSE rc + 1 END)::INT AS retry_count,
       CASE WHEN ok THEN ts_us + 1000000 ELSE ts_us + 5000000 END AS last_failed_us
FROM (SELECT *, (seq // 50) % 5 = 1 AS ok, CASE WHEN seq % 3 = 0 THEN 0 ELSE seq % 4 END AS rc FROM ticks WHERE seq % 50 = 0)""",
    )
)
def dlq_retry(spark, d):
    """Stored bodies read back and retried by a step that accepts lower-case tickers."""
    letters = _letters(spark, d)
    count = F.when(F.col("offset") % 3 != 0, F.col("offset") % 4).cast("int")
    bodies = deadletter.attributes(letters.withColumn("retry_count", count)).select("body")

    def lenient(df):
        checked = validate.market_events(df.drop("ticker"), "original_message")
        ok = F.col("error_field").isNull() | (F.col("error_field") == "ticker")
        return checked.withColumn("ok", ok)

    now = F.col("first_failed_us") + 4_000_000
    out = deadletter.retry(deadletter.read_bodies(bodies), lenient, now_us=now)
    return out.select("offset", "action", "retry_count", "last_failed_us")


@query(
    sql(
        "ticks",
        """SELECT ticker AS key, '{"ticker":"' || ticker || '","price":' || price::VARCHAR || ',"size":' || size || ',"ts_us":' || ts_us
       || ',"seq":' || seq || '}' AS value FROM ticks""",
    )
)
def trades_to_json(spark, d):
    return sinks.as_messages(src.ticks(spark, d))


@query(
    sql(
        "ticks",
        """SELECT kind, ticker, ts_us, seq, ttl FROM (
  SELECT 'trades' AS kind, ticker, ts_us, seq, ts_us // 1000000 + 172800 AS ttl FROM ticks
  UNION ALL SELECT 'features', ticker, ts_us, seq, ts_us // 1000000 + 604800 FROM ticks)
WHERE ttl >= 1704067200 + 172800 + 13000""",
    )
)
def retention_live(spark, d):
    t = src.ticks(spark, d).select("ticker", "ts_us", "seq")
    tables = [
        t.select(F.lit("trades").alias("kind"), "*", rules.expires_at("trades").alias("ttl")),
        t.select(F.lit("features").alias("kind"), "*", rules.expires_at("features").alias("ttl")),
    ]
    as_of = src.EPOCH_US + (172_800 + 13_000) * 1_000_000
    return keyed.live(tables[0].unionByName(tables[1]), as_of)
