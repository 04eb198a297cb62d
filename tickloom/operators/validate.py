"""Checks on incoming records. A bad record is a row with a reason, never an exception."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.exact import MAX_PRICE, MAX_SIZE, MIN_PRICE
from tickloom.functions.rules import (
    finite,
    parse_time,
    quote_event_id,
    quote_mid,
    quote_size,
    quote_spread,
    trade_event_id,
    whole_number,
)
from tickloom.sources.schemas import MARKET_FIELDS, NEWS_FIELDS, TICK_FIELDS

# The accepted ticker pattern and event types.
TICKER_PATTERN = "^[A-Z]{1,5}$"
EVENT_TYPES = ["trade", "quote"]

REASONS = {
    "json": "message is not JSON",
    "unknown": "message is not a JSON object",
    "ticker": "ticker must be 1 to 5 capital letters",
    "price": "price must be a positive number in range",
    "volume": "volume must be a whole number of at least 0 in range",
    "timestamp": "timestamp must be ISO-8601",
    "event_type": "event_type must be trade or quote",
    "sequence_number": "sequence_number must be a whole number",
    "no_ticker": "message has no ticker",
}


def decode_messages(df: DataFrame, value: str = "value", out: str = "raw") -> DataFrame:
    """Binary message values as text; values that are not UTF-8 are skipped."""
    text = F.try_validate_utf8(F.col(value).cast("string"))
    return df.withColumn(out, text).filter(F.col(out).isNotNull()).drop(*([value] if value != out else []))


def _fields(df: DataFrame, raw: str, names: list[str]) -> DataFrame:
    """Top-level JSON fields as text columns ``_<name>``.

    ``json_tuple`` parses a message once. Being a generator it also stops filters on the
    parsed values from being pushed below it, which would parse every message again.
    """
    return df.select("*", F.json_tuple(raw, *names).alias(*[f"_{n}" for n in names]))


def _object_error(raw: str, names: list[str]) -> Column:
    """json for text that does not parse, unknown for JSON that is no object.

    ``json_tuple`` and the parser stop at the end of the first value and take single
    quotes, so each message is checked strictly: as the only element of an array.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), F.col(raw), F.lit("]")))
    alone = F.try_variant_get(listed, "$[0]", "variant").isNotNull() & F.try_variant_get(listed, "$[1]", "variant").isNull()
    nothing = F.coalesce(*[F.col(f"_{n}") for n in names]).isNull()
    return F.when(~F.coalesce(alone, F.lit(False)), "json").when(nothing & ~F.ltrim(raw).startswith("{"), "unknown")


def market_events(
    df: DataFrame,
    raw: str = "raw",
    at: str = "ts_us",
    min_price: float = MIN_PRICE,
    max_price: float = MAX_PRICE,
    max_size: int = MAX_SIZE,
) -> DataFrame:
    """Parse and check raw JSON market messages.

    Adds ticker, price, volume, ``at``, event_type, sequence_number and ``error_field``,
    the first failing field in record order (null for a valid message). A price or volume
    that exact sums can't hold fails, so that one message can't end a whole job.
    """
    parsed = _fields(df, raw, MARKET_FIELDS).select(
        *df.columns,
        _object_error(raw, MARKET_FIELDS).alias("_object"),
        F.col("_ticker").alias("ticker"),
        finite("_price").alias("price"),
        whole_number("_volume").alias("volume"),
        parse_time("_timestamp").alias(at),
        F.col("_event_type").alias("event_type"),
        whole_number("_sequence_number").alias("sequence_number"),
    )

    def fails(ok: Column, field: str) -> Column:
        return F.when(~F.coalesce(ok, F.lit(False)), field)

    first = F.coalesce(
        F.col("_object"),
        fails(F.col("ticker").rlike(TICKER_PATTERN), "ticker"),
        fails((F.col("price") >= min_price) & (F.col("price") < max_price), "price"),
        fails((F.col("volume") >= 0) & (F.col("volume") < max_size), "volume"),
        fails(F.col(at).isNotNull(), "timestamp"),
        fails(F.col("event_type").isin(EVENT_TYPES), "event_type"),
        fails(F.col("sequence_number").isNotNull(), "sequence_number"),
    )
    return parsed.withColumn("error_field", first).drop("_object")


def valid_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("error_field").isNull()).drop("error_field")


def invalid_only(df: DataFrame) -> DataFrame:
    """Failing rows with a readable reason."""
    reasons = F.create_map(*[F.lit(x) for kv in REASONS.items() for x in kv])
    return df.filter(F.col("error_field").isNotNull()).withColumn(
        "error_reason", F.element_at(reasons, F.col("error_field"))
    )


def outcome_counts(df: DataFrame) -> DataFrame:
    """Valid messages and failures by field."""
    outcome = F.coalesce(F.col("error_field"), F.lit("valid"))
    return df.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


def trade_ok(min_price: float = MIN_PRICE, max_price: float = MAX_PRICE, max_size: int = MAX_SIZE) -> Column:
    """A ticker, and a price and size that exact sums can hold; NaN is larger than any number."""
    price = (F.col("price") >= min_price) & (F.col("price") < max_price)
    ok = F.col("ticker").isNotNull() & price & (F.col("size") >= 1) & (F.col("size") < max_size)
    return F.coalesce(ok, F.lit(False))


def quote_ok(max_price: float = MAX_PRICE, max_size: int = MAX_SIZE) -> Column:
    def within(c: str, limit: float, default: Column | None = None) -> Column:
        v = F.col(c) if default is None else F.coalesce(F.col(c), default)
        return F.coalesce((v >= 0) & (v < limit), F.lit(False))

    zero = F.lit(0).cast("bigint")
    return (
        F.col("ticker").isNotNull()
        & within("bid_price", max_price)
        & within("ask_price", max_price)
        & within("bid_size", max_size, zero)
        & within("ask_size", max_size, zero)
    )


def clean_ticker(c: str = "ticker") -> Column:
    return F.upper(F.trim(F.col(c)))


def trades(df: DataFrame, received: str | None = None) -> DataFrame:
    """Canonical trades with a ``valid`` flag; a missing time becomes the ``received`` time."""
    out = df.withColumn("ticker", clean_ticker())
    if received:
        out = out.withColumn("ts_us", F.coalesce("ts_us", received))
    return out.withColumn("valid", trade_ok())


def quotes(df: DataFrame, received: str | None = None) -> DataFrame:
    """Canonical quotes with a ``valid`` flag; missing sizes become 0."""
    zero = F.lit(0).cast("bigint")
    out = df.withColumn("ticker", clean_ticker())
    if received:
        out = out.withColumn("ts_us", F.coalesce("ts_us", received))
    return (
        out.withColumn("valid", quote_ok())
        .withColumn("bid_size", F.coalesce("bid_size", zero))
        .withColumn("ask_size", F.coalesce("ask_size", zero))
    )


def news(df: DataFrame, received: str | None = None) -> DataFrame:
    """Canonical news with a ``valid`` flag: whole id, trimmed non-empty headline."""
    out = (
        df.withColumn("id", whole_number(F.col("id").cast("string")))
        .withColumn("ticker", clean_ticker())
        .withColumn("headline", F.trim("headline"))
    )
    if received:
        out = out.withColumn("ts_us", F.coalesce("ts_us", received))
    ok = F.col("id").isNotNull() & F.col("ticker").isNotNull() & (F.length("headline") >= 1)
    return out.withColumn("valid", F.coalesce(ok, F.lit(False)))


def news_events(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Parse and check raw JSON news messages.

    Adds id, ticker, headline, summary, source, ts_us and ``error_field``: json, unknown
    (as for market messages), no_ticker, or null. Only what parses has a readable ticker.
    """
    error = F.coalesce("_object", F.when(F.col("_ticker").isNull(), "no_ticker"))
    return _fields(df, raw, NEWS_FIELDS).withColumn("_object", _object_error(raw, NEWS_FIELDS)).select(
        *df.columns,
        F.col("_article_id").alias("id"),
        F.when(F.col("_object").isNull(), F.col("_ticker")).alias("ticker"),
        F.col("_headline").alias("headline"),
        F.col("_summary").alias("summary"),
        F.col("_source").alias("source"),
        parse_time("_published_at").alias("ts_us"),
        error.alias("error_field"),
    )


def news_messages(df: DataFrame, raw: str = "raw") -> DataFrame:
    """The news of raw JSON messages; ``news_events`` with ``invalid_only`` gives the others."""
    return valid_only(news_events(df, raw)).drop(raw)


def tick_messages(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Raw JSON ticks (trades and quotes mixed) as one wide typed frame."""
    return _fields(df, raw, TICK_FIELDS).select(
        *df.columns,
        F.col("_ticker").alias("ticker"),
        finite("_price").alias("price"),
        whole_number("_size").alias("size"),
        parse_time("_timestamp").alias("ts_us"),
        F.col("_exchange").alias("exchange"),
        F.col("_trade_id").alias("trade_id"),
        F.from_json("_conditions", "array<string>").alias("conditions"),
        whole_number("_sequence").alias("sequence"),
        finite("_bid_price").alias("bid_price"),
        finite("_ask_price").alias("ask_price"),
        whole_number("_bid_size").alias("bid_size"),
        whole_number("_ask_size").alias("ask_size"),
    )


def dispatch(df: DataFrame) -> DataFrame:
    """Route mixed rows in one pass: a trade if it checks as one, else a quote, else ``dlq``.

    Quotes become synthetic trades at the mid price. Adds kind, price, size, spread and
    event_id; dead letters keep their input values.
    """
    checked = df.withColumn("ticker", clean_ticker()).withColumn(
        "kind", F.when(trade_ok(), "trade").when(quote_ok(), "quote").otherwise("dlq")
    )
    is_quote = F.col("kind") == "quote"
    content = ("ticker", "ts_us", "price", "size")
    return checked.select(
        *[F.col(c) for c in checked.columns if c not in ("price", "size")],
        F.when(is_quote, quote_mid()).otherwise(F.col("price")).alias("price"),
        F.when(is_quote, quote_size()).otherwise(F.col("size")).alias("size"),
        F.when(is_quote, quote_spread()).otherwise(F.lit(0.0)).alias("spread"),
        F.when(is_quote, quote_event_id()).otherwise(trade_event_id(content=content)).alias("event_id"),
    )
