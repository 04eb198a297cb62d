"""Record shapes. Fixed in code; nothing is inferred from data."""

from __future__ import annotations

# Fields of raw JSON messages. They are read as text, so that a wrong type is a failed
# check on one field and not a lost message.
MARKET_FIELDS = ["ticker", "price", "volume", "timestamp", "event_type", "sequence_number"]
TICK_FIELDS = [
    "ticker",
    "price",
    "size",
    "timestamp",
    "exchange",
    "trade_id",
    "conditions",
    "sequence",
    "bid_price",
    "ask_price",
    "bid_size",
    "ask_size",
]
NEWS_FIELDS = [
    "article_id",
    "ticker",
    "headline",
    "summary",
    "source",
    "url",
    "published_at",
    "ingested_at",
    "category",
]
LETTER_FIELDS = [
    "original_message",
    "error_reason",
    "error_type",
    "topic",
    "offset",
    "partition",
    "ticker",
    "retry_count",
    "first_failed_at",
    "last_failed_at",
]

MARKET_EVENT = "ticker string, price double, volume bigint, ts_us bigint, event_type string, sequence_number bigint"
TICK = "ticker string, price double, size bigint, ts_us bigint, seq bigint"
QUOTE = (
    "ticker string, bid_price double, ask_price double, bid_size bigint, ask_size bigint, "
    "ts_us bigint, seq bigint"
)
NEWS = "id bigint, ticker string, headline string, summary string, source string, ts_us bigint"
DEAD_LETTER = (
    "original_message string, error_reason string, error_type string, topic string, offset bigint, "
    "partition int, ticker string, retry_count int, first_failed_us bigint, last_failed_us bigint"
)
BAR = (
    "index string, date string, open double, high double, low double, close double, adj_close double, "
    "volume string, close_usd double"
)
