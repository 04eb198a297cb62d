"""Rolling metrics against fixed numbers and brute force."""

import math
import random
import statistics

import pytest

from tickloom.operators import rolling
from tickloom.operators.correlate import asof_backward

TICK = "ticker string, ts_us bigint, seq bigint, price double, size bigint"
S = 1_000_000

# Bucket widths and hot-bucket limits that force many cuts, none, and the default.
OPTIONS = [
    {"bucket_s": 60, "hot_rows": 4},
    {"bucket_s": 7, "hot_rows": None},
    {"bucket_s": 600, "hot_rows": 25},
    {},
]


def ticks(spark, rows):
    return spark.createDataFrame(rows, TICK)


def random_ticks(seed, n=400):
    """One ticker with most rows, bursts, gaps and equal times."""
    r = random.Random(seed)
    rows, t = [], 1_704_067_200 * S
    for i in range(n):
        t += r.choice([0, 1, 3, 250_000, S, 20 * S, 70 * S, 700 * S if i % 50 == 0 else S])
        ticker = r.choice(["HOT"] * 5 + ["B", "C"])
        rows.append((ticker, t, i, 50 + 0.25 * r.randrange(100), r.choice([0, 1, 5, 5, 5, 100, 4000])))
    return rows


def by_seq(df, *cols):
    return {r["seq"]: tuple(r[c] for c in cols) for r in df.collect()}


def z_prior(sizes):
    cur, prev = sizes[-1], sizes[:-1][-19:]
    if not prev:
        return 0.0
    mean = statistics.mean(prev)
    sd = statistics.stdev(prev) if len(prev) > 1 else 0.0
    if sd <= 1e-9:
        return 0.0 if cur == mean else (1.0 if cur > mean else -1.0)
    return (cur - mean) / sd


def brute(rows):
    out, seen = {}, {}
    for t in sorted({r[0] for r in rows}):
        own = sorted((r for r in rows if r[0] == t), key=lambda r: (r[1], r[2]))
        for i, (_, ts, seq, price, size) in enumerate(own):
            def frame(span):
                return [r for r in own if ts - span * S <= r[1] <= ts]

            def vwap(rs):
                v = sum(r[4] for r in rs)
                return sum(r[3] * r[4] for r in rs) / v if v else 0.0

            last = own[i - 1][3] if i else None
            f60, f300 = frame(60), frame(300)
            sizes = [r[4] for r in own[: i + 1]]
            incl = sizes[-20:]
            sd = statistics.pstdev(incl)
            then = [r for r in own if r[1] <= ts - 60 * S]
            gap = ts - own[i - 1][1] if i else None
            mom = (price - last) / last * 100 if last else 0.0
            out[seq] = {
                "vwap_1min": vwap(f60),
                "vwap_5min": vwap(f300),
                "avg_price_5min": sum(r[3] for r in f300) / len(f300),
                "trade_count_60s": len(f60),
                "volume_zscore": z_prior(sizes),
                "momentum": mom,
                "incl": (size - statistics.mean(incl)) / sd if len(incl) > 1 and sd > 0 else 0.0,
                "gap": mom if gap is not None and gap < 60 * S else 0.0,
                "ago": (price - then[-1][3]) / then[-1][3] * 100 if then else 0.0,
                "running": vwap(own[: i + 1]),
                "ordinal": i + 1,
                "ring": sizes[-20:],
            }
    return out


@pytest.mark.parametrize("opts", OPTIONS)
def test_enrich_matches_brute_force(spark, opts):
    rows = random_ticks(len(opts) + opts.get("bucket_s", 0))
    want = brute(rows)
    cols = ["vwap_1min", "vwap_5min", "avg_price_5min", "trade_count_60s", "volume_zscore", "momentum"]
    got = by_seq(rolling.enrich(ticks(spark, rows), **opts), *cols)
    assert got.keys() == want.keys()
    for s, values in got.items():
        assert values == pytest.approx(tuple(want[s][c] for c in cols), rel=1e-9, abs=1e-12), s


@pytest.mark.parametrize("opts", OPTIONS[:3])
def test_variants_match_brute_force(spark, opts):
    rows = random_ticks(99, 250)
    want = brute(rows)
    t = ticks(spark, rows)
    for fn, col, name in [
        (rolling.zscore_inclusive, "volume_zscore", "incl"),
        (rolling.momentum_gap, "momentum", "gap"),
        (rolling.momentum_ago, "momentum", "ago"),
        (rolling.running_vwap, "vwap", "running"),
        (rolling.ordinals, "ordinal", "ordinal"),
        (rolling.recent_sizes, "sizes", "ring"),
    ]:
        got = by_seq(fn(t, **opts), col)
        if name == "ring":
            assert {s: v[0] for s, v in got.items()} == {s: w[name] for s, w in want.items()}
        else:
            for s, (v,) in got.items():
                assert v == pytest.approx(want[s][name], rel=1e-9, abs=1e-12), (name, s)


def test_trailing_vwap_of_ten_ticks(spark):
    rows = [("AAPL", i * S, i, 100.0 + i, 10 + i) for i in range(10)]
    got = by_seq(rolling.trailing_vwap(ticks(spark, rows), 60), "vwap")
    want = sum((100.0 + i) * (10 + i) for i in range(10)) / sum(10 + i for i in range(10))
    assert got[9][0] == pytest.approx(want, rel=1e-12)


def test_span_is_closed_on_both_sides(spark):
    rows = [("A", 0, 0, 10.0, 1), ("A", 60 * S, 1, 20.0, 1), ("A", 60 * S + 1, 2, 30.0, 1)]
    got = by_seq(rolling.trailing_count(ticks(spark, rows), 60), "trade_count")
    assert [got[i][0] for i in range(3)] == [1, 2, 2]


def test_zscore_fixed_numbers(spark):
    sizes = list(range(10, 29)) + [38]
    rows = [("A", i * S, i, 1.0, s) for i, s in enumerate(sizes)]
    got = by_seq(rolling.zscore_prior(ticks(spark, rows)), "volume_zscore")
    assert got[0][0] == 0.0
    assert got[19][0] == pytest.approx((38 - 19) / statistics.stdev(range(10, 29)))
    for last, z in ((5, 0.0), (6, 1.0), (4, -1.0)):
        rows = [("A", i * S, i, 1.0, s) for i, s in enumerate([5, 5, 5, last])]
        assert by_seq(rolling.zscore_prior(ticks(spark, rows)), "volume_zscore")[3][0] == z


def test_zscore_of_huge_sizes(spark):
    rows = [("A", i * S, i, 1.0, s) for i, s in enumerate([10**12, 10**12, 10**12 + 1])]
    got = by_seq(rolling.zscore_prior(ticks(spark, rows)), "volume_zscore")
    assert [got[i][0] for i in range(3)] == [0.0, 0.0, 1.0]


def test_zscore_of_large_close_sizes(spark):
    import statistics

    sizes = [10**9 + (7 * i) % 4 for i in range(60)]
    t = ticks(spark, [("A", i * S, i, 1.0, s) for i, s in enumerate(sizes)])
    prior, own = by_seq(rolling.zscore_prior(t), "volume_zscore"), by_seq(rolling.zscore_inclusive(t), "volume_zscore")
    for i in range(25, 60):
        before, last = [s - 10**9 for s in sizes[i - 19 : i]], [s - 10**9 for s in sizes[i - 19 : i + 1]]
        x = sizes[i] - 10**9
        assert prior[i][0] == pytest.approx((x - statistics.mean(before)) / statistics.stdev(before), abs=1e-6)
        assert own[i][0] == pytest.approx((x - statistics.mean(last)) / statistics.pstdev(last), abs=1e-6)


def test_momentum_fixed_numbers(spark):
    for before, now, want in ((100.0, 110.0, 10.0), (100.0, 50.0, -50.0), (100.0, 105.0, 5.0), (0.0, 5.0, 0.0)):
        got = by_seq(rolling.momentum_tick(ticks(spark, [("A", 0, 0, before, 1), ("A", S, 1, now, 1)])), "momentum")
        assert got[0][0] == 0.0 and got[1][0] == pytest.approx(want)


def test_latency_pressure_needs_ten(spark):
    log = spark.createDataFrame(
        [("w", i * S, i, 150.0 if i < 15 else 10.0) for i in range(40)],
        "key string, ts_us bigint, seq bigint, latency_ms double",
    )
    got = by_seq(rolling.latency_pressure(log), "under_pressure")
    assert [s for s, (p,) in sorted(got.items()) if p] == list(range(9, 18))


def test_asof_tolerance_and_gaps(spark):
    right = spark.createDataFrame(
        [("A", 100 * S, 1, 1.0), ("A", 100 * S, 2, 2.0), ("A", 5000 * S, 3, 3.0), ("B", 0, 4, 4.0)],
        "ticker string, ts_us bigint, seq bigint, z double",
    )
    left = spark.createDataFrame(
        [(1, "A", 160 * S), (2, "A", 160 * S + 1000), (3, "A", 99 * S), (4, "A", 100 * S), (5, "C", S), (6, "A", 4999 * S)],
        "id bigint, ticker string, ts_us bigint",
    )
    for opts in OPTIONS:
        got = {r["id"]: r["z"] for r in asof_backward(left, right, ["z"], tolerance_s=60, **opts).collect()}
        assert got == {1: 2.0, 2: None, 3: None, 4: 2.0, 5: None, 6: None}
        free = {r["id"]: r["z"] for r in asof_backward(left, right, ["z"], tolerance_s=None, **opts).collect()}
        assert free == {1: 2.0, 2: 2.0, 3: None, 4: 2.0, 5: None, 6: 2.0}


@pytest.mark.parametrize("gap_us", [1000, 120_000])
def test_hot_ticker_is_spread_over_groups(spark, gap_us):
    """A busy ticker's rows must not share one window group, be they a burst or a stream."""
    from pyspark.sql import functions as F

    from tickloom.operators.ordered import hot_buckets, with_bucket

    t = ticks(spark, [("HOT", i * gap_us, i, 1.0, 1) for i in range(5000)])
    hot = hot_buckets(t, "ticker", "ts_us", 600, 100)
    sizes = with_bucket(t, hot, "ticker", "ts_us", 600).groupBy("_bucket").agg(F.count("*").alias("n"))
    assert sizes.count() >= 50 and sizes.agg(F.max("n")).first()[0] <= 110


@pytest.mark.parametrize("sizes", ["largest", "mixed"])
def test_every_accepted_size_and_price_passes(spark, sizes):
    """At the bounds of validation no sum overflows, and constant prices stay as they are."""
    from tickloom.functions.exact import MAX_PRICE, MAX_SIZE, MIN_PRICE
    from tickloom.operators import anomaly, windows

    top = math.nextafter(MAX_PRICE, 0)
    rows = [("A", i * 100_000, i, top, MAX_SIZE - 1 - (i % 7 if sizes == "mixed" else 0)) for i in range(500)]
    rows += [("B", i * 100_000, i, MIN_PRICE if i % 2 else top, MAX_SIZE - 1 if i % 3 else 0) for i in range(500)]
    t = ticks(spark, rows)
    for hot in (None, 100):
        opts = {"hot_rows": hot}
        vwap = rolling.trailing_vwap(t, 60, **opts).filter("ticker = 'A'").collect()
        assert all(r["vwap"] == pytest.approx(MAX_PRICE, rel=1e-12) for r in vwap)
        assert all(r["vwap"] == pytest.approx(MAX_PRICE, rel=1e-12) for r in rolling.running_vwap(t, **opts).filter("ticker = 'A'").collect())
        z = {r["seq"]: r["volume_zscore"] for r in rolling.zscore_prior(t, **opts).filter("ticker = 'A'").collect()}
        for i in range(30, 500):
            prior = [MAX_SIZE - 1 - (j % 7 if sizes == "mixed" else 0) for j in range(i - 19, i)]
            base = [p - MAX_SIZE for p in prior]
            m = sum(base) / 19
            sd = math.sqrt(sum((b - m) ** 2 for b in base) / 18)
            x = -1 - (i % 7 if sizes == "mixed" else 0)
            assert z[i] == (pytest.approx((x - m) / sd, rel=1e-9) if sd else 0.0)
        for f in (rolling.zscore_inclusive, rolling.vwap_deviation, rolling.trailing_mean_price, rolling.enrich, anomaly.features_7d, anomaly.features_6d):
            assert f(t, **opts).count() == 1000
    totals = windows.vwap_tumbling(t).filter("ticker = 'A'").collect()
    assert sum(r["volume"] for r in totals) == sum(r[4] for r in rows if r[0] == "A")
