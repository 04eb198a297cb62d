"""Per-tick rolling metrics.

All of them use event time and the ordering (ts_us, seq), and all are built on
``over_time`` / ``running`` / ``last_known``, which split a busy ticker's timeline.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions.exact import exact, notional, ratio
from tickloom.operators.ordered import last_known, over_time, running

ZSCORE_ROWS = 20


def _trailing(df: DataFrame, span_s: int, measures: dict[str, Column], **opts) -> DataFrame:
    return over_time(df, spans_s=[span_s], measures=measures, **opts)


def trailing_vwap(df: DataFrame, span_s: int = 60, out: str = "vwap", **opts) -> DataFrame:
    """Volume-weighted mean price over [t - span, t]; 0.0 without volume."""
    t = _trailing(df, span_s, {"_pv": notional(), "_v": F.col("size")}, **opts)
    return t.select(*df.columns, ratio(F.col(f"_pv_{span_s}"), F.col(f"_v_{span_s}")).alias(out))


def trailing_mean_price(df: DataFrame, span_s: int = 300, out: str = "avg_price", **opts) -> DataFrame:
    t = _trailing(df, span_s, {"_px": exact("price"), "_n": F.lit(1).cast("bigint")}, **opts)
    return t.select(*df.columns, ratio(F.col(f"_px_{span_s}"), F.col(f"_n_{span_s}")).alias(out))


def trailing_count(df: DataFrame, span_s: int = 60, out: str = "trade_count", **opts) -> DataFrame:
    t = _trailing(df, span_s, {"_n": F.lit(1).cast("bigint")}, **opts)
    return t.select(*df.columns, F.col(f"_n_{span_s}").alias(out))


def vwap_deviation(df: DataFrame, span_s: int = 300, out: str = "vwap_deviation", **opts) -> DataFrame:
    """price - trailing VWAP, 0.0 where there is no VWAP."""
    t = trailing_vwap(df, span_s, "_vwap", **opts)
    dev = F.when(F.col("_vwap") != 0, F.col("price") - F.col("_vwap")).otherwise(F.lit(0.0))
    return t.select(*df.columns, dev.alias(out))


def _spread(frame: WindowSpec, size: str) -> Column:
    """n * sum(x^2) - sum(x)^2 of whole numbers, in integers: in doubles it would cancel
    where values are large and close. Holds for sizes up to 10^13 and 99,999 rows."""
    whole = F.col(size).cast("decimal(16,0)")
    n = F.count(size).over(frame).cast("decimal(5,0)")
    s = F.sum(size).over(frame).cast("decimal(18,0)")
    return (n * F.sum((whole * whole).cast("decimal(28,0)")).over(frame).cast("decimal(32,0)") - s * s).cast("double")


def _prior_z(w: WindowSpec, n: int, size: str = "size") -> Column:
    """Current size against mean and sample deviation of the ``n`` rows before it."""
    prior = w.rowsBetween(-n, -1)
    x = F.col(size).cast("double")
    cnt = F.count(size).over(prior).cast("double")
    s = F.sum(size).over(prior).cast("double")
    flat = F.min(size).over(prior) == F.max(size).over(prior)
    z = ((cnt * x - s) / cnt) / F.sqrt(_spread(prior, size) / (cnt * (cnt - 1.0)))
    return F.when(cnt == 0, F.lit(0.0)).when(flat, F.signum(x - s / cnt)).otherwise(z)


def _inclusive_z(w: WindowSpec, n: int, size: str = "size") -> Column:
    """Current size against mean and population deviation of the last ``n`` rows with itself."""
    frame = w.rowsBetween(-(n - 1), 0)
    x = F.col(size).cast("double")
    cnt = F.count(size).over(frame).cast("double")
    s = F.sum(size).over(frame).cast("double")
    flat = F.min(size).over(frame) == F.max(size).over(frame)
    z = ((cnt * x - s) / cnt) / F.sqrt(_spread(frame, size) / (cnt * cnt))
    return F.when(flat, F.lit(0.0)).otherwise(z)


def percent_change(now: Column, before: Column) -> Column:
    """Percent change, 0.0 without a positive earlier value."""
    return F.when(before > 0, (now - before) / before * 100.0).otherwise(F.lit(0.0))


def zscore_prior(df: DataFrame, rows: int = ZSCORE_ROWS - 1, out: str = "volume_zscore", **opts) -> DataFrame:
    """Volume z-score against the rows before the current one.

    0 without history; with one earlier value or no spread it is the sign of the change.
    """
    return over_time(
        df, history=rows, history_cols=["size"], row_exprs={out: lambda w: _prior_z(w, rows)}, **opts
    )


def zscore_inclusive(df: DataFrame, rows: int = ZSCORE_ROWS, out: str = "volume_zscore", **opts) -> DataFrame:
    """Volume z-score against the last rows including the current one."""
    return over_time(
        df,
        history=rows - 1,
        history_cols=["size"],
        row_exprs={out: lambda w: _inclusive_z(w, rows)},
        **opts,
    )


def momentum_tick(df: DataFrame, out: str = "momentum", **opts) -> DataFrame:
    """Percent change from the previous tick."""
    return over_time(
        df,
        history=1,
        history_cols=["price"],
        row_exprs={out: lambda w: percent_change(F.col("price"), F.lag("price").over(w))},
        **opts,
    )


def momentum_gap(df: DataFrame, gap_s: int = 60, out: str = "momentum", **opts) -> DataFrame:
    """Percent change from the previous tick, 0.0 if that is ``gap_s`` or more ago."""

    def expr(w: WindowSpec) -> Column:
        near = F.col("ts_us") - F.lag("ts_us").over(w) < gap_s * 1_000_000
        change = percent_change(F.col("price"), F.lag("price").over(w))
        return F.when(near, change).otherwise(F.lit(0.0))

    return over_time(df, history=1, history_cols=["price"], row_exprs={out: expr}, **opts)


def momentum_ago(df: DataFrame, ago_s: int = 60, out: str = "momentum", **opts) -> DataFrame:
    """Percent change from the newest price at least ``ago_s`` old."""
    then = df.select(
        "ticker", (F.col("ts_us") + ago_s * 1_000_000).alias("ts_us"), "seq", F.col("price").alias("_then")
    )
    t = last_known(df, then, value="_then", **opts)
    return t.select(*df.columns, percent_change(F.col("price"), F.col("_then")).alias(out))


def running_vwap(df: DataFrame, out: str = "vwap", **opts) -> DataFrame:
    """VWAP of everything up to and including the current tick."""
    t = running(df, {"_pv": notional(), "_v": F.col("size").cast("decimal(38,0)")}, **opts)
    return t.select(*df.columns, ratio(F.col("_pv"), F.col("_v")).alias(out))


def running_trade_rate(df: DataFrame, width_s: int = 60, out: str = "trade_rate", **opts) -> DataFrame:
    """Trades so far in the clock window per elapsed minute of it."""
    from tickloom.functions.rules import window_start

    start = window_start("ts_us", width_s)
    w = df.withColumn("_w", start).withColumn("_kw", F.concat_ws("|", "ticker", "_w"))
    t = running(w, {"_n": F.lit(1).cast("bigint")}, key="_kw", **opts)
    minutes = (F.col("ts_us") - F.col("_w")) / 60e6
    return t.select(*df.columns, (F.col("_n") / F.greatest(F.lit(1e-6), minutes)).alias(out))


def ordinals(df: DataFrame, out: str = "ordinal", **opts) -> DataFrame:
    """1, 2, 3, … per ticker in time order."""
    return running(df, {out: F.lit(1).cast("bigint")}, **opts)


def recent_sizes(df: DataFrame, rows: int = ZSCORE_ROWS, out: str = "sizes", **opts) -> DataFrame:
    """The last sizes as an array, oldest first."""
    return over_time(
        df,
        history=rows - 1,
        history_cols=["size"],
        row_exprs={out: lambda w: F.collect_list("size").over(w.rowsBetween(-(rows - 1), 0))},
        **opts,
    )


def latency_pressure(
    df: DataFrame, rows: int = 10, limit_ms: float = 100.0, key: str = "key", **opts
) -> DataFrame:
    """Mean of the last latencies; under pressure when all of them are there and it is high."""

    def mean(w: WindowSpec) -> Column:
        f = w.rowsBetween(-(rows - 1), 0)
        return F.sum(exact("latency_ms")).over(f).cast("double") / F.count("*").over(f)

    def pressure(w: WindowSpec) -> Column:
        full = F.count("*").over(w.rowsBetween(-(rows - 1), 0)) >= rows
        return full & (mean(w) > limit_ms)

    return over_time(
        df,
        history=rows - 1,
        history_cols=["latency_ms"],
        row_exprs={"mean_latency_ms": mean, "under_pressure": pressure},
        key=key,
        **opts,
    )


def enrich(df: DataFrame, *, spans_s: Sequence[int] = (60, 300), **opts) -> DataFrame:
    """All per-tick metrics of the live path.

    Full rows are shuffled once; what buckets hand on are aggregates of slim copies.

    Adds vwap_1min, vwap_5min, avg_price_5min, trade_count_60s, volume_zscore, momentum.
    """
    short, long = spans_s
    t = over_time(
        df,
        spans_s=[short, long],
        measures={
            "_pv": notional(),
            "_v": F.col("size"),
            "_px": exact("price"),
            "_n": F.lit(1).cast("bigint"),
        },
        history=ZSCORE_ROWS - 1,
        history_cols=["size", "price"],
        row_exprs={
            "volume_zscore": lambda w: _prior_z(w, ZSCORE_ROWS - 1),
            "momentum": lambda w: percent_change(F.col("price"), F.lag("price").over(w)),
        },
        **opts,
    )
    return t.select(
        *df.columns,
        ratio(F.col(f"_pv_{short}"), F.col(f"_v_{short}")).alias("vwap_1min"),
        ratio(F.col(f"_pv_{long}"), F.col(f"_v_{long}")).alias("vwap_5min"),
        ratio(F.col(f"_px_{long}"), F.col(f"_n_{long}")).alias("avg_price_5min"),
        F.col(f"_n_{short}").alias("trade_count_60s"),
        "volume_zscore",
        "momentum",
    )
