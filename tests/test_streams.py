"""Streams against batch results, over several micro-batches and restarts."""

import json
import random
import uuid
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tickloom import session
from tickloom.operators import anomaly, rolling, validate, windows
from tickloom.plans.q_streams import SLICES, arriving
from tickloom.sources import readers, schemas, sinks
from tickloom.streaming import streams
from tickloom.streaming.state import AsOf, CutAnomalies, EnrichTicks, ScoreAnomalies, score_pieces
from tests.test_rolling import S, TICK, random_ticks, ticks
from tests.test_signals import SMALL, vectors

ONCE = {"availableNow": True}


def in_files(df, folder, n, by="ts_us"):
    """``df`` as n files in order of time, as they would arrive."""
    rows = sorted(df.collect(), key=lambda r: r[by])
    size = -(-len(rows) // n)
    for i in range(n):
        part = df.sparkSession.createDataFrame(rows[i * size : (i + 1) * size], df.schema)
        part.coalesce(1).write.mode("append").parquet(str(folder))


def stream(spark, folder, ddl):
    return readers.file_stream(spark, str(folder), ddl, max_files_per_trigger=1)


def test_enrich_over_batches_equals_batch(spark, tmp_path):
    t = ticks(spark, random_ticks(5, 300))
    in_files(t, tmp_path / "in", 4)
    s = streams.enrich(streams.timed(stream(spark, tmp_path / "in", TICK), "1 hour"))
    cols = ["vwap_1min", "vwap_5min", "avg_price_5min", "trade_count_60s", "volume_zscore", "momentum"]
    got = {r["seq"]: tuple(r[c] for c in cols) for r in streams.run_once(s, "t_enrich").collect()}
    want = {r["seq"]: tuple(r[c] for c in cols) for r in rolling.enrich(t).collect()}
    assert got.keys() == want.keys()
    for k in got:
        assert got[k] == pytest.approx(want[k], rel=1e-9, abs=1e-9), k


@pytest.mark.parametrize("files", [1, 3])
def test_enrich_of_large_close_sizes_equals_batch(spark, tmp_path, files):
    """Sizes near 10^7 and prices in cents, one ticker with nearly all rows."""
    r = random.Random(files)
    rows = [("A" if i % 50 else "B", 1000 * S + i * 700_000, i, r.randrange(1, 50_000) / 100, 10_000_000 + r.randrange(6)) for i in range(600)]
    rows += [("A", 1000 * S + (600 + i) * 700_000, 600 + i, 0.07, 5 * 10**9 * (i % 2) + 1) for i in range(40)]
    t = ticks(spark, rows)
    in_files(t, tmp_path / "in", files)
    s = streams.enrich(streams.timed(stream(spark, tmp_path / "in", TICK), "1 hour"))
    cols = ["vwap_1min", "vwap_5min", "avg_price_5min", "trade_count_60s", "volume_zscore", "momentum"]
    got = {x["seq"]: tuple(x[c] for c in cols) for x in streams.run_once(s, f"t_large{files}").collect()}
    want = {x["seq"]: tuple(x[c] for c in cols) for x in rolling.enrich(t).collect()}
    assert got.keys() == want.keys()
    for k in got:
        assert got[k] == pytest.approx(want[k], rel=1e-13), k


@pytest.mark.parametrize("width", [60, 300])
def test_open_windows_are_closed_at_the_end(spark, tmp_path, width):
    t = ticks(spark, random_ticks(8, 200))
    in_files(t, tmp_path / "in", 2)

    def step(df):
        return streams.vwap(df) if width == 60 else streams.mean_price_hopping(df)

    stored = streams.run_once(step(streams.timed(stream(spark, tmp_path / "in", TICK), "1 hour")), f"t_open{width}")
    mark = streams.final_watermark(t, delay="1 hour")
    whole = streams.with_open_windows(stored, step(streams.since(streams.timed(t), mark, width)), mark)
    want = windows.vwap_tumbling(t, 60) if width == 60 else windows.mean_price_hopping(t)
    assert stored.count() < want.count()
    keys = ["ticker", "window_start_us", "trade_count"]
    assert sorted(whole.select(keys).collect()) == sorted(want.select(keys).collect())


def test_split_of_news(spark, tmp_path):
    raws = ['{"article_id": "1", "ticker": "A", "headline": "h"}', '{"article_id": "2", "headline": "h"}', '{"ticker": "A"', "[]"]
    ddl = "raw string, topic string, partition int, offset bigint, received_us bigint"
    spark.createDataFrame([(r, "market.news", 0, i, 5) for i, r in enumerate(raws)], ddl).write.parquet(str(tmp_path / "in"))
    streams.start_split(
        stream(spark, tmp_path / "in", ddl), str(tmp_path / "out"), str(tmp_path / "ck"), trigger=ONCE, check=validate.news_events, queue="main"
    ).awaitTermination()
    assert [r["id"] for r in spark.read.parquet(str(tmp_path / "out/valid")).collect()] == ["1"]
    dead = spark.read.parquet(str(tmp_path / "out/dead_letters")).collect()
    assert {r["offset"]: (r["error_type"], r["ticker"], r["queue"], r["original_message"]) for r in dead} == {
        1: ("ValidationError", None, "main", raws[1]), 2: ("JsonError", None, "main", raws[2]), 3: ("JsonError", None, "main", raws[3])
    }


def test_windows_over_batches_equal_closed_batch_windows(spark, tmp_path):
    t = ticks(spark, random_ticks(6, 300))
    in_files(t, tmp_path / "in", 3)
    s = streams.vwap(streams.timed(stream(spark, tmp_path / "in", TICK), "10 seconds"))
    got = {(r["ticker"], r["window_start_us"]): r["vwap"] for r in streams.run_once(s, "t_vwap").collect()}
    want = {(r["ticker"], r["window_start_us"]): r["vwap"] for r in windows.vwap_tumbling(t).collect()}
    end = max(r["ts_us"] for r in t.collect()) // 1000 * 1000 - 10 * S
    assert got == {k: v for k, v in want.items() if k[1] + 60 * S <= end}


def test_late_rows_are_dropped_after_the_watermark(spark, tmp_path):
    early = ticks(spark, [("A", 1000 * S, 1, 1.0, 1), ("A", 5000 * S, 2, 1.0, 1)])
    late = ticks(spark, [("A", 1001 * S, 3, 9.0, 1), ("A", 9000 * S, 4, 1.0, 1)])
    # A row counts as late by the watermark known when the batch before it ran.
    between = ticks(spark, [("A", 5001 * S, 5, 1.0, 1)])
    for part in (early, between, late):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    s = streams.vwap(streams.timed(stream(spark, tmp_path / "in", TICK), "10 seconds"))
    got = {r["window_start_us"]: r["vwap"] for r in streams.run_once(s, "t_late").collect()}
    assert got[960 * S] == 1.0


def test_dedup_within_watermark(spark, tmp_path):
    t = ticks(spark, [("A", (1000 + i) * S, i, 1.0, 1) for i in range(20)])
    in_files(t, tmp_path / "in", 2)
    d = streams.timed(stream(spark, tmp_path / "in", TICK), "1 hour").select("*", F.explode(F.array(F.lit(1), F.lit(2))))
    assert streams.run_once(streams.first_seen(d, ["seq"]), "t_dedup").count() == 20


def test_restart_adds_each_row_once(spark, tmp_path):
    t = ticks(spark, [("A", i * S, i, 1.0, 1) for i in range(30)])
    src, table, ckpt = (str(tmp_path / p) for p in ("in", "table", "ckpt"))
    args = (table, ckpt, ["ticker", "ts_us", "seq"], ["price"])
    for lo, hi in ((0, 20), (10, 30)):  # the second delivery repeats ten rows
        t.filter(f"seq >= {lo} and seq < {hi}").coalesce(1).write.mode("append").parquet(src)
        streams.start_insert_if_absent(stream(spark, src, TICK), *args, trigger=ONCE).awaitTermination()
    assert sorted(r["seq"] for r in spark.read.parquet(table).collect()) == list(range(30))
    # A lost checkpoint replays everything and still adds nothing.
    streams.start_insert_if_absent(stream(spark, src, TICK), table, ckpt + "2", *args[2:], trigger=ONCE).awaitTermination()
    assert spark.read.parquet(table).count() == 30


def test_split_keeps_the_stream_going(spark, tmp_path):
    good = {"ticker": "A", "price": 1, "volume": 1, "timestamp": "2024-01-01T00:00:00Z", "event_type": "trade", "sequence_number": 1}
    raws = [json.dumps(good), "junk", json.dumps({**good, "price": 0})]
    df = spark.createDataFrame([(r, "t", 0, i, 5) for i, r in enumerate(raws)],
                               "raw string, topic string, partition int, offset bigint, received_us bigint")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    s = stream(spark, tmp_path / "in", "raw string, topic string, partition int, offset bigint, received_us bigint")
    streams.start_split(s, str(tmp_path / "out"), str(tmp_path / "ck"), trigger=ONCE).awaitTermination()
    assert [r["offset"] for r in spark.read.parquet(str(tmp_path / "out/valid")).collect()] == [0]
    dead = {r["offset"]: r["error_type"] for r in spark.read.parquet(str(tmp_path / "out/dead_letters")).collect()}
    assert dead == {1: "JsonError", 2: "ValidationError"}


SCORES = ("version", "raw_score", "score", "is_anomaly", "warming_up")


def test_stream_scores_equal_batch_scores(spark, tmp_path):
    """Ten micro-batches of uneven size, with a restart from the checkpoint in between."""
    v = vectors(spark, n=450)
    ddl = ", ".join(f"{n} {t}" for n, t in v.drop("ordinal").dtypes)
    root = str(tmp_path / "out")
    for lo, hi, files in ((0, 130, 3), (130, 131, 1), (131, 450, 6)):
        in_files(v.drop("ordinal").filter(f"seq >= {lo} and seq < {hi}"), tmp_path / "in", files)
        scored = streams.anomalies(stream(spark, tmp_path / "in", ddl), SMALL)
        streams.start(scored, root, name=f"t_scores{lo}", trigger=ONCE).awaitTermination()
    rows = spark.read.parquet(root + "/data").collect()
    got = {(r["ticker"], r["seq"]): tuple(r[c] for c in SCORES) for r in rows}
    want = {(r["ticker"], r["seq"]): tuple(r[c] for c in SCORES) for r in anomaly.score(v, SMALL).collect()}
    assert len(rows) == 900 and got == want


class _Value:
    def __init__(self):
        self.held = None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value


class _List:
    def __init__(self):
        self.held, self.reads = [], 0

    def get(self):
        self.reads += 1
        return iter(self.held)

    def put(self, rows):
        self.held = list(rows)

    def appendList(self, rows):
        self.held += rows


class _Map:
    def __init__(self):
        self.held = {}

    def getValue(self, key):
        return self.held.get(key)

    def updateValue(self, key, value):
        self.held[key] = value

    def removeKey(self, key):
        self.held.pop(key, None)

    def keys(self):
        return iter(list(self.held))

    def iterator(self):
        return iter(list(self.held.items()))


class _Handle:
    """A state handle in memory, to see what a step does with its state."""

    def __init__(self):
        self.states, self.timers, self.mark = {}, set(), 0

    def _made(self, name, kind):
        return self.states.setdefault(name, kind())

    def getValueState(self, name, schema):
        return self._made(name, _Value)

    def getListState(self, name, schema):
        return self._made(name, _List)

    def getMapState(self, name, key, value):
        return self._made(name, _Map)

    def registerTimer(self, ms):
        self.timers.add(ms)

    def getCurrentWatermarkInMs(self):
        return self.mark


def test_forest_is_held_until_one_is_due(spark, monkeypatch):
    """Ten new rows cost no refit and no read of the training rows."""
    fits = []
    given = anomaly.fitted
    monkeypatch.setattr(anomaly, "fitted", lambda x, t, v, f: fits.append((v, len(x))) or given(x, t, v, f))
    rows = vectors(spark, n=450).filter("ticker = 'A'").toPandas().sort_values("seq").drop(columns="ordinal")
    handle, out = _Handle(), []
    at = 0
    for size in (95, 10, 10, 84, 1, 10, 10, 230):
        step = ScoreAnomalies(SMALL)  # a fresh one each time: all it knows is in the state
        step.init(handle)
        reads, before = handle.states["rows"].reads, len(fits)
        out += list(step.handleInputRows(("A",), iter([rows.iloc[at : at + size]]), handle))
        due = (at + size) // SMALL.interval - at // SMALL.interval
        assert len(fits) - before == due and handle.states["rows"].reads - reads == min(due, 1)
        at += size
    assert fits == [(1, 100), (2, 200), (3, 300), (4, 400)] and len(handle.states["rows"].held) <= SMALL.window + SMALL.interval
    got = pd.concat(out)
    want = {r["seq"]: r["score"] for r in anomaly.score(vectors(spark, n=450), SMALL).filter("ticker = 'A'").collect()}
    assert dict(zip(got["seq"], got["score"], strict=True)) == want


def test_forests_within_a_batch_are_left_to_other_tasks(spark, monkeypatch):
    """A ticker's own task fits the forest it holds on; the others lie in pieces of fixed size."""
    fits = []
    given = anomaly.fitted
    monkeypatch.setattr(anomaly, "fitted", lambda x, t, v, f: fits.append((v, len(x))) or given(x, t, v, f))
    forest = replace(SMALL, block=2)
    rows = vectors(spark, n=450).filter("ticker = 'A'").toPandas().sort_values("seq").drop(columns="ordinal")
    handle, sent = _Handle(), []
    for lo, hi in ((0, 430), (430, 450)):
        step = CutAnomalies(forest)
        step.init(handle)
        sent += list(step.handleInputRows(("A",), iter([rows.iloc[lo:hi]]), handle))
    assert fits == [(4, 400)]
    parts = [list(score_pieces(forest)(iter([piece]))) for piece in reversed(sent)]  # in any order
    assert sorted(fits) == [(1, 100), (2, 200), (3, 300), (4, 400)]
    assert [len(p) for (p,) in reversed(parts)] == [100, 200, 100, 30, 20]
    got = pd.concat([p for part in parts for p in part]).set_index("seq")
    batch = anomaly.score(vectors(spark, n=450), SMALL).filter("ticker = 'A'").toPandas().set_index("seq").loc[got.index]
    assert all((got[c] == batch[c]).all() for c in (*SCORES, "ordinal"))


def test_recent_ticks_are_one_state_value():
    """A busy ticker's last five minutes are not put into the state row by row."""
    n, handle, out = 2000, _Handle(), []
    t = pd.DataFrame({"ticker": "A", "ts_us": np.arange(n) * 100_000, "seq": np.arange(n), "price": 1.0 + np.arange(n) % 7, "size": np.arange(n) % 5})
    for a in range(0, n, 500):
        step = EnrichTicks()
        step.init(handle)
        out += list(step.handleInputRows(("A",), iter([t.iloc[a : a + 500]]), handle))
    assert isinstance(handle.states["recent"], _Value) and len(handle.states["recent"].held) == 1
    got, one = pd.concat(out, ignore_index=True), EnrichTicks()
    one.init(fresh := _Handle())
    pd.testing.assert_frame_equal(got, next(one.handleInputRows(("A",), iter([t]), fresh)))


def test_slices_are_cut_in_one_pass(spark, tmp_path):
    """The input is computed once, not once a slice, and all its rows arrive."""
    folder = tmp_path / "passes"
    folder.mkdir()

    def noted(batches):
        (folder / uuid.uuid4().hex).touch()
        yield from batches

    df = spark.range(0, 400, numPartitions=2).selectExpr("id", "if(id = 7, null, id) AS n").mapInPandas(noted, "id bigint, n bigint")
    s = arriving(df, "passes", F.floor(F.col("n") / 60) - 1)
    assert len(list(folder.iterdir())) == 2
    q = streams.start(s, str(tmp_path / "out"), name="t_passes", trigger=ONCE)
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"]]) <= SLICES
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out/data")).collect()) == list(range(400))


def asof_by_hand(news, ticks_, tolerance):
    out = {}
    for i, t, at in news:
        before = [(x[1], x[2], x[4]) for x in ticks_ if x[0] == t and x[1] <= at]
        newest = max(before, default=None)
        out[i] = newest[2] if newest and at - newest[0] <= tolerance else None
    return out


def test_asof_stream_gives_every_article_once(spark, tmp_path):
    r = random.Random(4)
    rows = [("A" if r.random() < 0.8 else "B", 1000 * S + r.randrange(0, 900 * S), i, 1.0, i) for i in range(400)]
    rows += [("A", 1000 * S + 500 * S, 900 + i, 1.0, 5000 + i) for i in range(3)]  # ties at an article's second
    rows = [x for x in rows if not 1600 * S < x[1] < 1700 * S]  # a gap longer than the tolerance
    news = [(i, r.choice("ABC"), 1000 * S + r.randrange(0, 900) * S) for i in range(150)] + [(500, "A", 1500 * S), (501, "A", 1690 * S)]
    t = ticks(spark, rows)
    n = spark.createDataFrame(news, "id bigint, ticker string, ts_us bigint")
    in_files(t, tmp_path / "t", 6)
    in_files(n, tmp_path / "n", 6)
    delay = "30 seconds"
    s = streams.asof(
        streams.timed(stream(spark, tmp_path / "n", "id bigint, ticker string, ts_us bigint"), delay),
        streams.timed(stream(spark, tmp_path / "t", TICK), delay).withColumn("volume_zscore", F.col("size").cast("double")),
    )
    matched = streams.run_once(s, "t_asof").collect()
    want = asof_by_hand(news, rows, 60 * S)
    got = {x["id"]: x["volume_zscore"] for x in matched}
    assert len(got) == len(matched) > 100 and got == {i: want[i] for i in got}
    assert any(v is None for v in got.values())
    mark = streams.final_watermark(t, n, delay=delay)
    z = t.withColumn("volume_zscore", F.col("size").cast("double"))
    whole = streams.with_open_articles(n, spark.createDataFrame(matched, "id bigint, ticker string, ts_us bigint, volume_zscore double"), z, mark)
    assert {x["id"]: x["volume_zscore"] for x in whole.collect()} == want


def test_asof_state_is_a_value_a_second():
    """800 ticks a second for ten minutes leave as many values as the tolerance has seconds."""
    handle = _Handle()
    step = AsOf(60 * S, S)
    step.init(handle)
    for second in range(600):
        at = np.arange(800) * 1250 + second * S
        part = pd.DataFrame({"is_news": False, "at": at, "seq": at, "value": at.astype(float), "id": None})
        handle.mark = max(0, second - 5) * 1000
        list(step.handleInputRows(("A",), iter([part]), handle))
        assert len(handle.states["newest"].held) <= 60 + 5 + 4
    news = pd.DataFrame({"is_news": [True], "at": [597 * S], "seq": [0], "value": [None], "id": [1]})
    list(step.handleInputRows(("A",), iter([news]), handle))
    handle.mark = 597_000
    out = pd.concat(step.handleExpiredTimer(("A",), handle, None))
    assert handle.timers == {597_000} and out.values.tolist() == [[1, "A", 597 * S, 597.0 * S]]
    assert not handle.states["waiting"].held


def test_asof_works_once_a_batch():
    """500 articles that wait have one timer and are sent out by it; state is read once, not for each."""
    handle, reads = _Handle(), []
    step = AsOf(60 * S, S)
    step.init(handle)
    for name in ("newest", "waiting"):
        held = handle.states[name]
        for what in ("keys", "iterator"):
            setattr(held, what, lambda f=getattr(held, what), n=name: reads.append(n) or f())
    at = np.arange(500) * S
    ticks_ = pd.DataFrame({"is_news": False, "at": at, "seq": at, "value": at.astype(float), "id": None})
    news = pd.DataFrame({"is_news": True, "at": at[::-1], "seq": 0, "value": None, "id": np.arange(500)})
    twice = pd.concat([news, news.tail(3)], ignore_index=True)
    list(step.handleInputRows(("A",), iter([ticks_, twice]), handle))
    assert handle.timers == {0} and sorted(reads) == ["newest", "waiting"]
    got = []
    for mark, timer in ((249_500, 250_000), (600_000, 250_000)):
        handle.mark = mark
        reads.clear()
        got.append(pd.concat(step.handleExpiredTimer(("A",), handle, None)))
        assert sorted(reads) == ["newest", "waiting"] and max(handle.timers) == timer
    assert [len(g) for g in got] == [250, 250] and not handle.states["waiting"].held
    out = pd.concat(got)
    assert (out["value"] == out["ts_us"]).all() and (out["ts_us"] == (499 - out["id"]) * S).all()
    again = pd.concat(step.handleExpiredTimer(("A",), handle, None))
    assert not len(again) and len(handle.states["newest"].held) <= 65


@pytest.mark.parametrize("hot_rows", [20, 100_000])
def test_ordered_stream_equals_batch(spark, tmp_path, hot_rows):
    """One ticker with most rows, cut into buckets; the stream stops and goes on in between."""
    t = ticks(spark, random_ticks(9, 400))
    root = str(tmp_path / "out")
    mid = t.approxQuantile("ts_us", [0.5], 0)[0]
    for half in (f"ts_us <= {mid}", f"ts_us > {mid}"):
        in_files(t.filter(half), tmp_path / "in", 3)
        s = stream(spark, tmp_path / "in", TICK)
        streams.start_ordered(s, root, root + "/ck", rolling.enrich, span_s=300, rows=20, hot_rows=hot_rows, trigger=ONCE).awaitTermination()
    cols = ["seq", "vwap_1min", "vwap_5min", "avg_price_5min", "trade_count_60s", "volume_zscore", "momentum"]
    schema = rolling.enrich(t).schema
    got = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(root + "/out")
    assert sorted(got.select(cols).collect()) == sorted(rolling.enrich(t).select(cols).collect())
    read = streams.ordered_stream(spark, root + "/out", schema, maxFilesPerTrigger=4)
    assert streams.run_once(read, f"t_read{hot_rows}").count() == 400


def test_ordered_stream_spreads_a_hot_ticker(spark, tmp_path):
    """A ticker with two thirds of a micro-batch is worked on in several buckets."""
    rows = [("HOT" if i % 3 else f"T{i % 7}", 1000 * S + i * 10_000, i, 1.0, i % 50) for i in range(6000)]
    in_files(ticks(spark, rows), tmp_path / "in", 1)
    seen = str(tmp_path / "buckets")

    def operator(df, **opts):
        from tickloom.operators.ordered import hot_buckets, with_bucket

        hot = hot_buckets(df, "ticker", "ts_us", opts["bucket_s"], opts["hot_rows"])
        with_bucket(df, hot, "ticker", "ts_us", opts["bucket_s"]).groupBy("ticker", "_bucket").count().write.parquet(seen)
        return rolling.zscore_prior(df, **opts)

    root = str(tmp_path / "out")
    s = stream(spark, tmp_path / "in", TICK)
    streams.start_ordered(s, root, root + "/ck", operator, span_s=0, rows=20, hot_rows=500, trigger=ONCE).awaitTermination()
    hot = [r["count"] for r in spark.read.parquet(seen).filter("ticker = 'HOT'").collect()]
    assert len(hot) >= 8 and max(hot) <= 600


def test_missing_rows_of_the_last_batch_are_an_error(spark, tmp_path):
    t = ticks(spark, random_ticks(3, 60))
    root = str(tmp_path / "out")

    def run():
        s = stream(spark, tmp_path / "in", TICK)
        streams.start_ordered(s, root, root + "/ck", rolling.zscore_prior, span_s=0, rows=20, trigger=ONCE).awaitTermination()

    in_files(t.filter("ts_us < 0"), tmp_path / "in", 1)  # an empty first batch
    in_files(t, tmp_path / "in", 1)
    run()
    out = spark.read.option("recursiveFileLookup", True).parquet(root + "/out")
    assert out.count() == t.count()
    for b in (tmp_path / "out/handed").iterdir():
        b.rename(tmp_path / f"gone-{b.name}")
    t.limit(5).write.mode("append").parquet(str(tmp_path / "in"))
    with pytest.raises(StreamingQueryException, match="is missing"):
        run()


def test_late_rows_become_a_table(spark, tmp_path):
    """On time and late rows are all rows; windows over the first drop nothing more."""
    r = random.Random(2)
    rows = [("A", (1000 + i) * S, i, 1.0, 1) for i in range(300)]
    sent = sorted(rows, key=lambda x: x[1] + (r.randrange(0, 120) * S if r.random() < 0.2 else 0))
    for i in range(0, 300, 50):
        ticks(spark, sent[i : i + 50]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    root = str(tmp_path / "out")
    for _ in range(2):  # the second run finds nothing new
        s = stream(spark, tmp_path / "in", TICK)
        streams.start_late_split(s, root, root + "/ck", delay_s=10, trigger=ONCE).awaitTermination()
    late = {x["seq"] for x in spark.read.option("recursiveFileLookup", True).parquet(root + "/late").collect()}
    time = {x["seq"] for x in spark.read.option("recursiveFileLookup", True).parquet(root + "/on_time").collect()}
    newest, want = 0, set()
    for i in range(0, 300, 50):
        part = sent[i : i + 50]
        want |= {x[2] for x in part if newest and x[1] < newest - 10 * S}
        newest = max([newest, *[x[1] for x in part]])
    assert late == want and late and not late & time and len(late | time) == 300


def test_hopping_windows_keep_sums_per_hop(spark, tmp_path):
    t = ticks(spark, random_ticks(6, 300))
    in_files(t, tmp_path / "in", 4)
    s = streams.mean_price_hopping(streams.timed(stream(spark, tmp_path / "in", TICK), "10 seconds"))
    got = {(x["ticker"], x["window_start_us"]): (x["avg_price"], x["trade_count"]) for x in streams.run_once(s, "t_hop").collect()}
    want = {(x["ticker"], x["window_start_us"]): (x["avg_price"], x["trade_count"]) for x in windows.mean_price_hopping(t).collect()}
    assert got and got.items() <= want.items()


def test_archive_reads_only_the_asked_folders(spark, tmp_path):
    t = ticks(spark, [("A", 1_704_067_200 * S + i * 1800 * S, i, 1.0, 1) for i in range(10)])
    root = str(tmp_path / "archive")
    sinks.write_archive(t, root)
    hour = readers.archive(spark, root, schemas.TICK, hour="02")
    assert sorted(r["seq"] for r in hour.collect()) == [4, 5]
    plan = hour._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hour" in plan
    sinks.register(spark, "ticks_archive", root, schemas.TICK)
    assert spark.table("ticks_archive").count() == 10
    assert spark.sql("SHOW PARTITIONS ticks_archive").count() == 5


ROW = "ticker string, ts_us bigint, v string, version int"
KEYS = ["ticker", "ts_us"]


def test_upsert_rewrites_touched_days_only(spark, tmp_path):
    day = 86_400 * S
    root = str(tmp_path / "t")
    a = spark.createDataFrame([("A", 0, "old", 1), ("A", day, "keep", 1)], ROW)
    sinks.upsert(a, "days_touched", root, KEYS, ["version"])
    before = set(spark.table("days_touched").filter("day = '02'").inputFiles())
    b = spark.createDataFrame([("A", 0, "new", 2), ("A", 1, "more", 1)], ROW)
    sinks.upsert(b, "days_touched", root, KEYS, ["version"])
    assert sorted(r["v"] for r in spark.table("days_touched").collect()) == ["keep", "more", "new"]
    assert before == set(spark.table("days_touched").filter("day = '02'").inputFiles())


@pytest.mark.parametrize("done", [0, 1])
def test_failed_upsert_loses_nothing(spark, tmp_path, monkeypatch, done):
    """A put that fails after ``done`` of its two days; putting it again finishes it."""
    day, table, root = 86_400 * S, f"days_failed{done}", str(tmp_path / "t")
    old = [("A", i * day, f"old{i}", 1) for i in range(3)]
    sinks.upsert(spark.createDataFrame(old, ROW), table, root, KEYS, ["version"])
    new = spark.createDataFrame([("A", 0, "new0", 2), ("A", day, "new1", 2), ("B", day, "more", 1), ("A", 2 * day, "stale", 0)], ROW)
    given = sinks._switch

    def fails(spark_, table_, staged, days):
        given(spark_, table_, staged, days[:done])
        raise OSError("the driver died")

    monkeypatch.setattr(sinks, "_switch", fails)
    with pytest.raises(OSError):
        sinks.upsert(new, table, root, KEYS, ["version"])
    got = sorted(r["v"] for r in spark.table(table).collect())
    assert got == (["old0", "old1", "old2"] if not done else ["new0", "old1", "old2"])
    monkeypatch.setattr(sinks, "_switch", given)
    sinks.upsert(new, table, root, KEYS, ["version"])
    assert sorted(r["v"] for r in spark.table(table).collect()) == ["more", "new0", "new1", "old2"]


def test_an_upsert_computes_its_batch_once_and_shuffles_finely(spark, tmp_path, monkeypatch):
    """However few partitions the session asks for, adaptive execution merges from many."""
    calls, asked = spark.sparkContext.accumulator(0), []
    seen = F.udf(lambda x: (calls.add(1), x)[1], "double").asNondeterministic()
    given = sinks.keep_last
    monkeypatch.setattr(sinks, "keep_last", lambda *a: asked.append(spark.conf.get(session.INITIAL_PARTITIONS)) or given(*a))
    t = ticks(spark, random_ticks(3, 200)).withColumn("version", F.lit(1)).withColumn("price", seen("price"))
    sinks.upsert(t, "fine_puts", str(tmp_path), ["ticker", "ts_us", "seq"], ["version"])
    sinks.upsert(t, "fine_puts", str(tmp_path), ["ticker", "ts_us", "seq"], ["version"])
    assert calls.value == 400 and spark.table("fine_puts").count() == 200
    assert min(map(int, asked)) >= 1000 and spark.conf.get(session.INITIAL_PARTITIONS, None) is None


def test_dead_letter_archive_folders(spark, tmp_path):
    from tests.test_records import letters

    sinks.archive_dead_letters(letters(spark, [3]), str(tmp_path / "dead"))
    r = spark.read.json(str(tmp_path / "dead/year=1970/month=01/day=01")).first()
    assert r["name"] == "unknown_0" and r["retry_count"] == 3


def test_messages_are_keyed_by_ticker(spark):
    r = sinks.as_messages(ticks(spark, [("A", 1, 2, 3.5, 4)])).first()
    assert r["key"] == "A" and json.loads(r["value"]) == {"ticker": "A", "ts_us": 1, "seq": 2, "price": 3.5, "size": 4}
