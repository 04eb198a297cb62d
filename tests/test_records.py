"""Checks, rules, normalising, keyed tables, dead letters and bars on fixed cases."""

import json

import pytest
from pyspark.sql import functions as F

from tickloom.functions import rules
from tickloom.operators import bars, deadletter, keyed, monitor, normalize, serving, validate, windows

OK = {
    "ticker": "LOOM",
    "price": 37.5,
    "volume": 240,
    "timestamp": "2023-11-07T14:05:09Z",
    "event_type": "trade",
    "sequence_number": 88,
}


def without(k):
    return {a: b for a, b in OK.items() if a != k}


CASES = [
    (OK, None),
    ({**OK, "ticker": "MSFT", "volume": 0, "event_type": "quote"}, None),
    ({**OK, "price": "150.25", "volume": 100.0, "sequence_number": "7"}, None),
    ({**OK, "timestamp": "2024-01-15T10:30:00+02:00", "extra": [1]}, None),
    ({**OK, "timestamp": 1705314600}, None),
    ({**OK, "price": -1}, "price"),
    ({**OK, "price": 0}, "price"),
    ({**OK, "price": "NaN"}, "price"),
    ({**OK, "volume": -1}, "volume"),
    ({**OK, "volume": 1.5}, "volume"),
    (without("ticker"), "ticker"),
    ({**OK, "ticker": "aapl"}, "ticker"),
    ({**OK, "ticker": "TOOLONG"}, "ticker"),
    ({**OK, "event_type": "invalid"}, "event_type"),
    ({**OK, "timestamp": "not-a-date"}, "timestamp"),
    (without("timestamp"), "timestamp"),
    (without("sequence_number"), "sequence_number"),
    ({"ticker": "AAPL", "price": -1}, "price"),
    ({}, "ticker"),
]
TEXTS = [(json.dumps(m), f) for m, f in CASES] + [
    ("not json", "json"),
    ('{"ticker": "AAPL", "pri', "json"),
    ("", "json"),
    ("[1, 2]", "unknown"),
    ("3", "unknown"),
    ("null", "unknown"),
    (json.dumps(OK) + " xyz", "json"),
    (json.dumps(OK) + ", {}", "json"),
    (json.dumps(OK).replace('"', "'"), "json"),
]


def test_market_messages(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TEXTS)], "i int, raw string")
    got = {r["i"]: r["error_field"] for r in validate.market_events(df).collect()}
    for i, (text, field) in enumerate(TEXTS):
        assert got[i] == field, text
    counts = {r["outcome"]: r["n"] for r in validate.outcome_counts(validate.market_events(df)).collect()}
    assert counts["valid"] == 5 and counts["price"] == 4 and sum(counts.values()) == len(TEXTS)
    bad = validate.invalid_only(validate.market_events(df))
    assert bad.filter(F.col("error_reason").isNull()).count() == 0


def test_prices_must_be_finite(spark):
    kind = "ticker string, price double, size bigint, bid_price double, ask_price double, bid_size bigint, ask_size bigint"
    inf, nan = float("inf"), float("nan")
    rows = [("A", p, 1, p, 1.0, 1, 1) for p in (1.0, inf, nan)]
    df = spark.createDataFrame(rows, kind)
    assert [r["valid"] for r in validate.trades(df).collect()] == [True, False, False]
    assert [r["valid"] for r in validate.quotes(df).collect()] == [True, False, False]


def test_numbers_that_sums_cannot_hold_fail(spark):
    """One such price used to end every job that sums prices."""
    texts = [json.dumps({**OK, **more}) for more in ({}, {"price": 1e11}, {"price": 1e-9}, {"volume": 10**18}, {"price": 9_999_999_999.5})]
    df = validate.market_events(spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "raw string, seq int"))
    assert [r["error_field"] for r in df.orderBy("seq").collect()] == [None, "price", "price", "volume", None]
    ticks = validate.valid_only(df).select("ticker", "price", F.col("volume").alias("size"), "ts_us", "seq")
    assert windows.vwap_tumbling(ticks, 60).count() == 1
    kind = "ticker string, price double, size bigint, bid_price double, ask_price double, bid_size bigint, ask_size bigint"
    rows = [("A", p, n, p, 1.0, n, 1) for p, n in ((1.0, 1), (1e10, 1), (1.0, 10**18))]
    assert [r["valid"] for r in validate.trades(spark.createDataFrame(rows, kind)).collect()] == [True, False, False]
    assert [r["valid"] for r in validate.quotes(spark.createDataFrame(rows, kind)).collect()] == [True, False, False]
    wide = [r["valid"] for r in spark.createDataFrame(rows, kind).select(validate.trade_ok(max_price=1e12).alias("valid")).collect()]
    assert wide == [True, True, False]


def test_long_dead_letters_can_be_retried(spark):
    text = json.dumps({**OK, "price": -1, "note": "x" * 20_000})
    bad = validate.invalid_only(validate.market_events(spark.createDataFrame([(text,)], "raw string")))
    letters = deadletter.dead_letters(bad, failed_us=F.lit(1))
    assert [r["original_message"] for r in letters.collect()] == [text]
    short = deadletter.dead_letters(bad, failed_us=F.lit(1), max_chars=50)
    assert [len(r["original_message"]) for r in short.collect()] == [50]


def test_latency_ranks_are_exact(spark):
    import math
    import random

    r = random.Random(2)
    rows = [("a", r.expovariate(0.01)) for _ in range(2001)] + [("b", 5.0)] * 100 + [("c", 1.25), ("c", None)]
    got = {x["key"]: (x["p50_ms"], x["p99_ms"], x["n"]) for x in monitor.latency_by_key(spark.createDataFrame(rows, "key string, latency_ms double")).collect()}
    for key in "abc":
        v = sorted(x for k, x in rows if k == key and x is not None)
        assert got[key] == (v[math.ceil(len(v) * 0.5) - 1], v[math.ceil(len(v) * 0.99) - 1], len(v))


def test_offset_times_are_utc(spark):
    df = spark.createDataFrame([(json.dumps({**OK, "timestamp": t}),) for t in
                                ("2024-01-15T10:30:00+02:00", "2024-01-15T08:30:00Z", "2024-01-15T08:30:00")], "raw string")
    assert {r["ts_us"] for r in validate.market_events(df).collect()} == {1705307400000000}


def test_undecodable_bytes_are_skipped(spark):
    df = spark.createDataFrame([(bytearray(b"ok"),), (bytearray(b"\xff\xfe"),), (bytearray("é".encode()),)], "value binary")
    assert sorted(r["raw"] for r in validate.decode_messages(df).collect()) == ["ok", "é"]


def test_trades_and_quotes(spark):
    t = spark.createDataFrame(
        [(" aapl ", 1.0, 1, None, 5), ("A", 1.0, None, 1, 5), ("A", -1.0, 1, 1, 5), ("A", 0.0, 1, 1, 5), ("A", 1.0, 0, 1, 5)],
        "ticker string, price double, size bigint, ts_us bigint, received_us bigint",
    )
    got = validate.trades(t, "received_us").collect()
    assert [r["valid"] for r in got] == [True, False, False, False, False]
    assert got[0]["ticker"] == "AAPL" and got[0]["ts_us"] == 5


@pytest.mark.parametrize(
    "bid,ask,mid,spread", [(10.0, 11.0, 10.5, 1.0), (0.0, 11.0, 11.0, 0.0), (0.0, 0.0, 1e-6, 0.0), (11.0, 10.0, 10.5, 0.0)]
)
def test_quote_mid(spark, bid, ask, mid, spread):
    r = spark.createDataFrame([(bid, ask, 0, 0)], "bid_price double, ask_price double, bid_size bigint, ask_size bigint").select(
        rules.quote_mid().alias("m"), rules.quote_spread().alias("s"), rules.quote_size().alias("n")
    ).first()
    assert (r["m"], r["s"], r["n"]) == (mid, spread, 1)


def test_dispatch(spark):
    raw = [
        {"ticker": "a", "price": 10, "size": 5, "trade_id": "x", "timestamp": "2024-01-01T00:00:00Z", "conditions": ["1"]},
        {"ticker": "b", "bid_price": 1, "ask_price": 3, "timestamp": "2024-01-01T00:00:00Z"},
        {"ticker": "c", "price": -1, "size": 5},
        {"price": 1, "size": 5},
    ]
    df = spark.createDataFrame([(json.dumps(m),) for m in raw], "raw string")
    got = validate.dispatch(validate.tick_messages(df)).collect()
    assert [r["kind"] for r in got] == ["trade", "quote", "dlq", "dlq"]
    assert got[0]["event_id"] == "x" and got[0]["ticker"] == "A" and got[0]["conditions"] == ["1"]
    assert (got[1]["price"], got[1]["size"], got[1]["spread"]) == (2.0, 1, 2.0)
    assert got[1]["event_id"].startswith("Q|B|1704067200000000000|")


def test_news(spark):
    df = spark.createDataFrame(
        [("42", "nvda", " up "), ("x", "A", "t"), ("1", "A", ""), ("2", "A", "   ")], "id string, ticker string, headline string"
    )
    got = validate.news(df).collect()
    assert [r["valid"] for r in got] == [True, False, False, False]
    assert (got[0]["id"], got[0]["ticker"], got[0]["headline"]) == (42, "NVDA", "up")


def test_labels_and_strength(spark):
    df = spark.createDataFrame([(0.05,), (-0.05,), (0.0499,)], "c double")
    rows = df.select(rules.sentiment_label("c"), rules.sentiment_label("c", inclusive=False)).collect()
    assert [r[0] for r in rows] == ["positive", "negative", "neutral"] and {r[1] for r in rows} == {"neutral"}
    cases = [
        (0.5, 3.0, "strong"), (-0.6, 3.1, "strong"), (0.2, 2.0, "moderate"), (0.9, 2.5, "moderate"),
        (0.1, 5.0, "weak"), (0.9, 1.9, "none"), (0.9, None, "none"),
    ]
    df = spark.createDataFrame(cases, "s double, z double, want string")
    for r in df.select("want", rules.correlation_strength("s", "z").alias("got")).collect():
        assert r["got"] == r["want"]


def test_shards_are_used_and_stable(spark):
    df = spark.range(100).select(F.lit("AAPL").alias("ticker"), F.col("id").alias("ts_us"))
    first = [r[0] for r in df.select(rules.shard_key("ticker", "ts_us")).collect()]
    again = [r[0] for r in df.repartition(7).orderBy("ts_us").select(rules.shard_key("ticker", "ts_us")).collect()]
    assert first == again and 2 <= len(set(first)) <= 8


def test_universe_and_range(spark):
    assert normalize.universe(" A ,,B ") == ["A", "B"]
    df = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3)], "ticker string, ts_us bigint")
    assert normalize.in_universe(df, ["A", "C"]).count() == 2
    assert keyed.between(df, 2, None).count() == 2 and keyed.between(df, None, 1).count() == 1
    with pytest.raises(ValueError):
        keyed.between(df, 3, 2)
    with pytest.raises(ValueError):
        keyed.latest_n(df, 101)


def test_vendor_time_is_exact(spark):
    ns = 1_704_067_200_123_456_789
    df = spark.createDataFrame([("a", 1.0, 2, ns, 3, "i", None, 9)],
                               "symbol string, price double, size bigint, timestamp bigint, exchange int, id string, conditions array<int>, sequence_number bigint")
    r = normalize.vendor_trades(df).first()
    assert r["ts_us"] == ns // 1000 and r["conditions"] is None and r["exchange"] == "3"


def test_snapshot_falls_back_to_close(spark):
    df = spark.createDataFrame([("A", 0.0, 9.996, 1.0, 2.0), ("B", 0.0, 0.0, 0.0, 0.0), ("C", 5.0, 4.0, 1.0, 25.0)],
                               "ticker string, c double, pc double, d double, dp double").select(
        "*", F.lit(None).cast("double").alias("h"), F.lit(1.0).alias("l"), F.lit(1.0).alias("o"))
    got = {r["ticker"]: r for r in normalize.snapshot_quotes(df).collect()}
    assert set(got) == {"A", "C"} and got["A"]["price"] == 10.0 and got["A"]["change"] == 0.0 and got["C"]["change_pct"] == 25.0


def test_keyed_tables(spark):
    rows = [("A", 1, "x"), ("A", 1, "y"), ("A", 2, "z")]
    df = spark.createDataFrame(rows, "ticker string, ts_us bigint, v string")
    assert sorted(r["v"] for r in keyed.keep_first(df, ["ticker", "ts_us"], ["v"]).collect()) == ["x", "z"]
    assert sorted(r["v"] for r in keyed.keep_last(df, ["ticker", "ts_us"], ["v"]).collect()) == ["y", "z"]
    new = keyed.insert_if_absent(df, df.filter("ts_us = 2"), ["ticker", "ts_us"], ["v"])
    assert [r["v"] for r in new.collect()] == ["x"]
    assert keyed.insert_if_absent(df, df, ["ticker", "ts_us"], ["v"]).count() == 0


def test_copies_of_one_key_are_combined_before_the_shuffle(spark):
    """A key that is a third of all rows leaves each map task as one row."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    plan = keyed.keep_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Aggregate") >= 2 and "partial_min_by" in plan


def test_retention(spark):
    t0 = 1_704_067_200 * 1_000_000
    df = spark.createDataFrame([("A", t0), ("A", t0 + 10_000_000)], "ticker string, ts_us bigint")
    stamped = df.withColumn("ttl", rules.expires_at("trades"))
    assert stamped.first()["ttl"] == 1_704_067_200 + 172_800
    assert keyed.live(stamped, t0 + (172_800 + 5) * 1_000_000).count() == 1


def letters(spark, counts):
    rows = [(f"m{i}", "r", "ValidationError", "t", i, 0, None, c, 1, 1) for i, c in enumerate(counts)]
    return spark.createDataFrame(
        rows,
        "original_message string, error_reason string, error_type string, topic string, offset bigint, "
        "partition int, ticker string, retry_count int, first_failed_us bigint, last_failed_us bigint",
    )


def test_retries(spark):
    fail = lambda d: d.withColumn("ok", F.lit(False))
    got = deadletter.retry(letters(spark, [0, 1, 2]), fail, now_us=F.lit(9)).collect()
    assert [(r["action"], r["retry_count"]) for r in got] == [("requeue", 1), ("requeue", 2), ("archive", 3)]
    assert {r["last_failed_us"] for r in got} == {9}
    one = deadletter.retry(letters(spark, [1]), fail, now_us=F.lit(9), max_retries=1).first()
    assert one["action"] == "archive"
    done = deadletter.retry(letters(spark, [1]), lambda d: d.withColumn("ok", F.lit(True)), now_us=F.lit(9)).first()
    assert (done["action"], done["retry_count"], done["last_failed_us"]) == ("done", 1, 1)


def test_dead_letter_bodies_round_trip(spark):
    with_queue = letters(spark, [2]).withColumn("queue", F.lit("main"))
    sent = deadletter.attributes(with_queue)
    assert sent.first()["ticker"] == "unknown"
    back = deadletter.read_bodies(sent.select("body")).first()
    assert (back["original_message"], back["retry_count"], back["last_failed_us"]) == ("m0", 2, 1)
    empty = deadletter.read_bodies(spark.createDataFrame([("{}",)], "body string"), now_us=F.lit(7)).first()
    assert (empty["original_message"], empty["retry_count"], empty["first_failed_us"]) == ("", 0, 7)


def test_bars(spark):
    df = spark.createDataFrame([("NYA", "31/12/86", 1.0, 2.0, 0.5, 1.5, 1.5, "0", 1.0)], "index string, date string, open double, high double, low double, close double, adj_close double, volume string, close_usd double")
    r = bars.clean(df).first()
    assert str(r["date"]) == "1986-12-31" and r["volume"] is None
    assert str(bars.clean(df.withColumn("date", F.lit("01/02/07")), pivot=50).first()["date"]) == "2007-02-01"
    line = bars.to_lines(bars.clean(df)).first()["line"]
    assert line == "NYA,1986-12-31,1.0,2.0,0.5,1.5,1.5,N/A,1.0"
    quoted = spark.createDataFrame([('"N,Y",1986-12-31,1,2,0.5,1.5,1.5,7,1',)], "line string")
    back = bars.from_lines(quoted).first()
    assert back["index"] == "N,Y" and back["volume"] == 7


def test_lag_counts_unread_partitions_in_full(spark):
    df = spark.createDataFrame([("t", 0, 0, 100, 90), ("t", 1, 10, 60, None), ("t", 2, 0, 5, 9)],
                               "topic string, partition int, low bigint, high bigint, committed bigint")
    assert monitor.consumer_lag(df).first()["lag"] == 10 + 50 + 0


def test_alerts(spark):
    df = spark.createDataFrame([("ConsumerLag", 4999.0), ("ConsumerLag", 5000.0), ("DeadLetterDepth", 100.0), ("x", 1e9)], "name string, value double")
    assert sorted(r["level"] for r in monitor.alert_levels(df).collect()) == ["critical", "ok", "ok", "warning"]


def test_latency_stats_use_nearest_rank(spark):
    df = spark.range(1000).select(
        F.col("id").alias("ts_us"), F.col("id").alias("seq"), F.col("id").cast("double").alias("latency_ms"),
        F.lit(200).alias("status"), F.lit(False).alias("is_external"), F.lit(False).alias("is_static"))
    r = monitor.latency_stats(df, 1000).first()
    assert (r["p50_ms"], r["p99_ms"], r["total_requests"], r["status"]) == (950.0, 999.0, 1000, "degraded")
    none = monitor.latency_stats(df.filter("id < 0") if "id" in df.columns else df.filter("seq < 0"), 0).first()
    assert (none["p99_ms"], none["error_rate_pct"], none["status"]) == (0.0, 0.0, "healthy")


def test_standardize_without_spread(spark):
    df = spark.createDataFrame([("A", 1.0), ("A", 1.0), ("B", 1.0), ("B", 3.0)], "ticker string, x double")
    got = sorted((r["ticker"], r["x"]) for r in monitor.standardize(df, monitor.feature_stats(df, ["x"]), ["x"]).collect())
    assert got == [("A", 0.0), ("A", 0.0), ("B", -1.0), ("B", 1.0)]


def test_prices_fall_back(spark):
    live = spark.createDataFrame([("A", 5.0, 1.0, 4.0), ("B", 0.0, 1.0, 4.0)], "ticker string, price double, change_pct double, previous_close double")
    wanted = spark.createDataFrame([("A",), ("B",), ("C",)], "ticker string")
    got = {r["ticker"]: (r["price"], r["origin"]) for r in serving.prices(live, wanted, {"B": (7.0, 0.0, 7.0)}).collect()}
    assert got == {"A": (5.0, "live"), "B": (7.0, "static"), "C": (100.0, "default")}
