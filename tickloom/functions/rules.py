"""Scalar rules: labels, keys, ids and quote arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds and lifetimes every result depends on.
LABEL_BOUND = 0.05
STRONG_SENTIMENT = 0.5
MODERATE_SENTIMENT = 0.2
UNUSUAL_Z = 2.0
EXTREME_Z = 3.0
MIN_MID = 1e-6
SHARDS = 8
RETENTION_S = {
    "trades": 48 * 3600,
    "aggregations": 7 * 86400,
    "features": 7 * 86400,
    "anomalies": 30 * 86400,
    "sentiment": 30 * 86400,
}
ALERTS = [
    ("ConsumerLag", 5000.0, 10000.0),
    ("StoreWriteLatencyP99", 50.0, 100.0),
    ("StoreThrottles", 10.0, 50.0),
    ("DeadLetterDepth", 50.0, 100.0),
    ("ProducerErrors", 5.0, 20.0),
    ("ReadLatencyP99", 200.0, 500.0),
]


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sentiment_label(compound: Column | str, inclusive: bool = True) -> Column:
    """positive / negative / neutral; the bound itself counts as a label if inclusive."""
    c = _c(compound)
    pos = c >= LABEL_BOUND if inclusive else c > LABEL_BOUND
    neg = c <= -LABEL_BOUND if inclusive else c < -LABEL_BOUND
    return F.when(pos, "positive").when(neg, "negative").otherwise("neutral")


def correlation_strength(compound: Column | str, z: Column | str) -> Column:
    """none unless volume was unusual, else strong / moderate / weak."""
    s, z = F.abs(_c(compound)), _c(z)
    return (
        F.when(z.isNull() | (z < UNUSUAL_Z), "none")
        .when((s >= STRONG_SENTIMENT) & (z >= EXTREME_Z), "strong")
        .when(s >= MODERATE_SENTIMENT, "moderate")
        .otherwise("weak")
    )


def spike_level(z: Column | str) -> Column:
    z = _c(z)
    return F.when(z > EXTREME_Z, "extreme").when(z > UNUSUAL_Z, "unusual").otherwise("normal")


def _two_sided(bid: Column, ask: Column) -> Column:
    return (bid > 0) & (ask > 0)


def quote_mid(bid: Column | str = "bid_price", ask: Column | str = "ask_price") -> Column:
    b, a = _c(bid), _c(ask)
    return F.when(_two_sided(b, a), (b + a) / 2.0).otherwise(F.greatest(b, a, F.lit(MIN_MID)))


def quote_size(bid: Column | str = "bid_size", ask: Column | str = "ask_size") -> Column:
    zero = F.lit(0).cast("bigint")
    return F.greatest(
        F.coalesce(_c(bid), zero), F.coalesce(_c(ask), zero), F.lit(1).cast("bigint")
    )


def quote_spread(bid: Column | str = "bid_price", ask: Column | str = "ask_price") -> Column:
    b, a = _c(bid), _c(ask)
    return F.when(_two_sided(b, a), F.greatest(a - b, F.lit(0.0))).otherwise(F.lit(0.0))


def trade_event_id(
    trade_id: str = "trade_id", sequence: str = "sequence", content: tuple[str, ...] = ()
) -> Column:
    """Vendor id, else sequence, else a hash of the content so that replays dedupe."""
    return F.coalesce(
        F.when(F.col(trade_id) != "", F.col(trade_id)),
        F.col(sequence).cast("string"),
        F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in content]), 256),
    )


def quote_event_id(
    ticker: str = "ticker", ts: str = "ts_us", bid: str = "bid_price", ask: str = "ask_price"
) -> Column:
    return F.concat_ws(
        "|",
        F.lit("Q"),
        F.col(ticker),
        (F.col(ts) * 1000).cast("string"),
        F.col(bid).cast("string"),
        F.col(ask).cast("string"),
    )


def timestamp(ts: Column | str = "ts_us") -> Column:
    return F.timestamp_micros(_c(ts))


def iso_time(ts: Column | str = "ts_us") -> Column:
    return F.date_format(timestamp(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def parse_time(text: Column | str) -> Column:
    """ISO-8601 text, or epoch seconds / milliseconds as text, to epoch µs; null if neither."""
    t = _c(text)
    number = t.try_cast("double")
    # Numbers up to 2e10 are seconds, larger ones milliseconds.
    scale = F.when(F.abs(number) <= 2e10, F.lit(1e6)).otherwise(F.lit(1e3))
    numeric = F.when(number.isNotNull() & ~F.isnan(number) & (F.abs(number) < 9e15), F.round(number * scale))
    iso = F.when(t.rlike(r"^\s*\d{4}-\d{2}-\d{2}([T _]\d{2}:\d{2}.*)?$"), F.try_to_timestamp(t))
    return F.coalesce(numeric.cast("bigint"), F.unix_micros(iso))


def hour_bucket_key(ticker: str = "ticker", ts: str = "ts_us") -> Column:
    return F.concat(F.col(ticker), F.lit("#"), F.date_format(timestamp(ts), "yyyy-MM-dd-HH"))


def shard_key(ticker: str = "ticker", *spread: str, shards: int = SHARDS) -> Column:
    """ticker#n with n from the leading MD5 digits of the values, the same in every process."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (ticker, *spread)])
    n = F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(shards))
    return F.concat(F.col(ticker), F.lit("#"), n.cast("string"))


def sequence_shard_key(ticker: str = "ticker", sequence: str = "seq", shards: int = SHARDS) -> Column:
    """ticker#n dealt out in turn by sequence number."""
    n = F.pmod(F.col(sequence), F.lit(shards))
    return F.concat(F.col(ticker), F.lit("#"), n.cast("string"))


def expires_at(table: str, ts: str = "ts_us") -> Column:
    """Epoch second after which a row of the table is expired."""
    return F.floor(F.col(ts) / 1_000_000).cast("bigint") + F.lit(RETENTION_S[table])


def whole_number(text: Column | str) -> Column:
    """Text to BIGINT; "100" and "100.0" pass, "100.5" gives null."""
    t = _c(text)
    d = t.try_cast("double")
    return F.coalesce(
        t.try_cast("bigint"),
        F.when(~F.isnan(d) & (F.abs(d) < 9e15) & (d == F.floor(d)), d).try_cast("bigint"),
    )


def finite(text: Column | str) -> Column:
    """Text to DOUBLE, null for anything but a finite number."""
    d = _c(text).try_cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), d)


def window_start(ts: Column | str = "ts_us", width_s: int = 60) -> Column:
    """Start (epoch µs) of the epoch-aligned window of ``width_s`` seconds."""
    t = _c(ts)
    return t - F.pmod(t, F.lit(width_s * 1_000_000))
