"""Vendor payloads, keys and maps in canonical form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.rules import expires_at, iso_time, parse_time, sequence_shard_key, shard_key
from tickloom.operators.validate import clean_ticker


def _from_ns(ns: str, received: str | None) -> Column:
    t = F.expr(f"`{ns}` div 1000")
    return F.coalesce(t, F.col(received)) if received else t


def vendor_trades(df: DataFrame, received: str | None = None) -> DataFrame:
    """symbol, price, size, timestamp (ns), exchange, id, conditions, sequence_number to trades."""
    codes = F.transform("conditions", lambda c: c.cast("string"))
    return df.select(
        F.upper(F.trim(F.coalesce("symbol", F.lit("")))).alias("ticker"),
        F.coalesce(F.col("price").cast("double"), F.lit(0.0)).alias("price"),
        F.coalesce(F.col("size").cast("bigint"), F.lit(0).cast("bigint")).alias("size"),
        _from_ns("timestamp", received).alias("ts_us"),
        F.col("exchange").cast("string").alias("exchange"),
        F.col("id").cast("string").alias("trade_id"),
        F.when(F.size(codes) > 0, codes).alias("conditions"),
        F.col("sequence_number").alias("sequence"),
    )


def vendor_quotes(df: DataFrame, received: str | None = None) -> DataFrame:
    """symbol, bid/ask price and size, timestamp (ns) to quotes."""
    zero = F.lit(0).cast("bigint")
    return df.select(
        F.upper(F.trim(F.coalesce("symbol", F.lit("")))).alias("ticker"),
        F.coalesce(F.col("bid_price").cast("double"), F.lit(0.0)).alias("bid_price"),
        F.coalesce(F.col("ask_price").cast("double"), F.lit(0.0)).alias("ask_price"),
        F.coalesce(F.col("bid_size").cast("bigint"), zero).alias("bid_size"),
        F.coalesce(F.col("ask_size").cast("bigint"), zero).alias("ask_size"),
        _from_ns("timestamp", received).alias("ts_us"),
    )


def short_named(df: DataFrame) -> DataFrame:
    """symbol/sym, price/p, size/s to ticker, price, volume, event_type.

    A row with ask or bid is a quote. Rows without ticker or positive price are dropped.
    """

    def either(long: str, short: str, empty: Column) -> Column:
        return F.coalesce(F.when(F.col(long) != empty, F.col(long)), F.col(short), empty)

    out = df.select(
        *[c for c in df.columns if c not in ("symbol", "sym", "price", "p", "size", "s", "ask", "bid")],
        either("symbol", "sym", F.lit("")).alias("ticker"),
        either("price", "p", F.lit(0.0)).alias("price"),
        either("size", "s", F.lit(0).cast("bigint")).alias("volume"),
        F.when(F.col("ask").isNotNull() | F.col("bid").isNotNull(), "quote").otherwise("trade").alias("event_type"),
    )
    return out.filter((F.col("ticker") != "") & (F.col("price") > 0))


def articles(df: DataFrame, received: str | None = None) -> DataFrame:
    """Polled articles to news: whole id and headline required, time from epoch s or ISO text."""
    at = parse_time("datetime")
    return (
        df.select(
            F.trim("id").try_cast("bigint").alias("id"),
            clean_ticker().alias("ticker"),
            F.trim(F.coalesce("headline", F.lit(""))).alias("headline"),
            "summary",
            "url",
            "source",
            (F.coalesce(at, F.col(received)) if received else at).alias("ts_us"),
        )
        .filter(F.col("id").isNotNull() & (F.col("headline") != ""))
    )


def universe(tickers: str) -> list[str]:
    """A comma-separated setting as a list, blanks dropped."""
    return [t.strip() for t in tickers.split(",") if t.strip()]


def in_universe(df: DataFrame, tickers: Sequence[str] | DataFrame) -> DataFrame:
    """Rows of allowed tickers. A list becomes a pushed-down filter, a table a semi join."""
    if not isinstance(tickers, DataFrame):
        return df.filter(F.col("ticker").isin(list(tickers)))
    return df.join(tickers, "ticker", "left_semi")


def sort_key_parts(df: DataFrame, sk: str = "sk", default: Column | None = None) -> DataFrame:
    """Split ``time#id``: ts_us (``default`` where the time does not parse) and event_id."""
    parts = F.split(sk, "#", 2)
    at = parse_time(F.get(parts, 0))
    return df.select(
        "*",
        (at if default is None else F.coalesce(at, default)).alias("ts_us"),
        F.get(parts, 1).alias("event_id"),
    )


def numeric_map(m: str) -> Column:
    """A text map with numeric values only; null where nothing is left."""
    doubles = F.map_filter(F.transform_values(m, lambda _, v: v.try_cast("double")), lambda _, v: v.isNotNull())
    return F.when(F.size(doubles) > 0, doubles)


def read_features(df: DataFrame, m: str = "features") -> DataFrame:
    """Feature maps as columns, with the names older writers used as fallbacks."""

    def first_of(*names: str) -> Column:
        return F.coalesce(*[F.element_at(m, n) for n in names], F.lit(0.0))

    return df.select(
        *[c for c in df.columns if c != m],
        first_of("vwap_5min", "vwap_5m", "vwap_1min").alias("vwap_5min"),
        first_of("volume_zscore").alias("volume_zscore"),
        first_of("price_momentum", "momentum").alias("price_momentum"),
        first_of("trade_frequency").alias("trade_frequency"),
        F.element_at(m, "bid_ask_spread").alias("bid_ask_spread"),
    )


def snapshot_quotes(df: DataFrame) -> DataFrame:
    """Snapshot rows (c, pc, d, dp, h, l, o) rounded to cents; no current price falls back to the close.

    Rows without either price are dropped.
    """

    def cents(c: str) -> Column:
        return F.round(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), 2)

    r = df.select(
        *[c for c in df.columns if c not in ("c", "pc", "d", "dp", "h", "l", "o")],
        *[cents(c).alias(f"_{c}") for c in ("c", "pc", "d", "dp", "h", "l", "o")],
    )
    closed = (F.col("_c") <= 0) & (F.col("_pc") > 0)
    return r.select(
        *[c for c in r.columns if not c.startswith("_")],
        F.when(closed, F.col("_pc")).otherwise(F.col("_c")).alias("price"),
        F.when(closed, 0.0).otherwise(F.col("_d")).alias("change"),
        F.when(closed, 0.0).otherwise(F.col("_dp")).alias("change_pct"),
        F.col("_pc").alias("previous_close"),
        F.col("_h").alias("high"),
        F.col("_l").alias("low"),
        F.col("_o").alias("open"),
    ).filter(F.col("price") > 0)


def keyed_items(df: DataFrame, table: str, event_id: str, *fields: str, sharded: bool = True) -> DataFrame:
    """Rows as keyed-store items: pk, sk, ts as text, ttl and the given fields."""
    pk = F.col("ticker")
    if sharded:
        pk = sequence_shard_key("ticker", "seq") if "seq" in df.columns else shard_key("ticker", event_id)
    return df.select(
        pk.alias("pk"),
        F.concat_ws("#", iso_time(), F.col(event_id).cast("string")).alias("sk"),
        "ticker",
        iso_time().alias("ts"),
        expires_at(table).alias("ttl"),
        *fields,
    )


def request_details(df: DataFrame) -> DataFrame:
    """Request-log rows with the ticker in the path and what to leave out of statistics."""
    # Data routes, and routes that wait for outside services.
    data = "^/(?:quotes|aggregations|anomalies|features|sentiment)/([^/]+)"
    outside = "^/(?:market-prices|quote/|sentiment/)"
    ticker = F.regexp_extract("path", data, 1)
    return df.select(
        "*",
        F.when(ticker != "", F.upper(ticker)).alias("ticker"),
        F.col("path").rlike(outside).alias("is_external"),
        F.col("path").startswith("/static").alias("is_static"),
    )
