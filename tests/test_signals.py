"""Sentiment, correlation and anomaly operators."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.functions import iforest
from tickloom.operators import anomaly, correlate, sentiment, windows

LEX = [("good", 1900, "word"), ("bad", -2500, "word"), ("not", 0, "negator"), ("very", 0, "booster"), ("barely", 0, "dampener"), ("flat", 0, "word")]


def lexicon(spark):
    return spark.createDataFrame(LEX, "token string, valence bigint, role string")


def by_hand(text):
    spelled = [t for t in (w.strip("'") for w in re.split(r"(?:(?!')[\W\d_])+", text.replace("\u2019", "'"))) if t]
    toks, loud = [t.lower() for t in spelled], [t.isupper() for t in spelled]
    mixed = 0 < sum(loud) < len(toks)
    turn = toks.index("but") if "but" in toks else None
    words = {t: v for t, v, r in LEX if r == "word"}
    lifts = {"very": 1, "barely": -1}
    s = pos = neg = 0
    charged = 0
    for i, t in enumerate(toks):
        if t not in words:
            continue
        v = words[t] * 1000
        side = (v > 0) - (v < 0)
        v += side * 733_000 * (loud[i] and mixed)
        for weight, j in zip((1, 0.95, 0.9), range(i - 1, max(-1, i - 4), -1), strict=False):
            if toks[j] in lifts:
                v += round(side * weight * (293_000 * lifts[toks[j]] + 733_000 * (loud[j] and mixed)))
        v = round(v * -0.74) if any(b == "not" or b.endswith("n't") for b in toks[max(0, i - 3) : i]) else v
        if turn is not None and i != turn:
            v *= 0.5 if i < turn else 1.5
        s += v
        charged += v != 0
        pos += v + 1_000_000 if v > 0 else 0
        neg += 1_000_000 - v if v < 0 else 0
    marks = 292_000 * min(4, text.count("!"))
    asks = text.count("?")
    marks += 0 if asks < 2 else 180_000 * asks if asks < 4 else 960_000
    s += marks * ((s > 0) - (s < 0))
    pos, neg = pos + marks * (pos > neg), neg + marks * (neg > pos)
    total = pos + neg + (len(toks) - charged) * 1_000_000
    comp = s / math.sqrt(s * s + 15e12)
    return len(toks), comp, pos / total if total else 0.0, neg / total if total else 0.0


def test_sentiment_matches_hand_count(spark):
    r = random.Random(3)
    vocab = ["good", "bad", "not", "very", "flat", "day", "the", "Good,", "NOT", "x1y", "barely", "don't", "isn\u2019t", "'good'", "bad!", "good?", "GOOD", "VERY", "BARELY", "DON'T"]
    texts = [" ".join(r.choice([*vocab, *["but", "But"] * (i % 2)]) for _ in range(r.randrange(0, 30))) for i in range(90)]
    texts += ["", "...", "été good", "GOOD BAD", "but", "good but bad", "VERY good", "good " * 20_000 + "but not VERY bad"]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    for limit in ("10MB", "-1"):  # broadcast, and the shuffled join for large lexicons
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        got = {x["id"]: x for x in sentiment.score(df, lexicon(spark)).collect()}
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert len(got) == len(texts)
        for i, t in enumerate(texts):
            n, comp, pos, neg = by_hand(t)
            g = got[i]
            assert g["n_tokens"] == n and g["compound"] == pytest.approx(comp, abs=1e-12)
            assert (g["positive"], g["negative"]) == pytest.approx((pos, neg), abs=1e-12)
            if n:
                assert g["positive"] + g["neutral"] + g["negative"] == pytest.approx(1.0)


def test_published_sentences(spark):
    """A "but" turns a text, capitals weigh more only beside words without."""
    texts = ["good but bad", "bad but good", "very good day", "VERY good day", "good day", "GOOD day", "GOOD DAY", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    c = [r["compound"] for r in sentiment.score(df, lexicon(spark)).orderBy("id").collect()]
    assert c[0] < 0 < c[1] and c[4] < c[2] < c[3] and c[4] < c[5] and c[6] == c[4] and c[7] == 0.0


def test_words_are_not_shuffled_to_a_small_lexicon(spark, monkeypatch):
    """Words meet the lexicon where they are, even if Spark would not broadcast it by itself."""
    given = [(i, t, f"s{i % 3}" if i % 4 else None) for i, t in enumerate(["a good but BAD day!", "not good", "", "nothing here", "good " * 40, None])]
    texts = spark.createDataFrame(given, "id bigint, text string, source string")
    words = spark.createDataFrame([("good", 1900, "word"), ("bad", -2500, "word"), ("not", 0, "negator")], "token string, valence bigint, role string")

    def scored():
        df = sentiment.score(texts, words, carry=("source",))
        return df, sorted(df.collect(), key=lambda r: r["id"])

    near, got = scored()
    plan = near._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert [(r["id"], r["source"]) for r in got] == [(i, s) for i, _, s in given]
    monkeypatch.setattr(sentiment, "LEXICON_BYTES", 0)
    far, same = scored()
    assert "SortMergeJoin" in far._jdf.queryExecution().sparkPlan().toString() and same == got


def test_text_parts(spark):
    df = spark.createDataFrame([(" a ", " b "), ("a", None), ("", ""), (None, "x" * 300)], "headline string, summary string")
    assert [r["text"] for r in sentiment.news_text(df).collect()] == ["a b", "a", "x" * 300]
    assert [len(r["text"]) for r in sentiment.news_text(df, summary_chars=200).collect()] == [3, 1, 200]


def windows_of(spark, z, c):
    t = spark.createDataFrame([("A", 60_000_000, z, 1)], "ticker string, window_start_us bigint, max_zscore double, trade_count bigint")
    s = spark.createDataFrame([("A", 61_000_000, 1, c)], "ticker string, ts_us bigint, id bigint, compound double")
    return correlate.strong_correlations(t, windows.news_window_summary(s))


@pytest.mark.parametrize("z,c,n", [(2.0, 0.51, 0), (2.1, 0.51, 1), (2.1, 0.5, 0), (2.1, -0.51, 1)])
def test_strong_correlation_bounds(spark, z, c, n):
    rows = windows_of(spark, z, c).collect()
    assert len(rows) == n
    if n:
        assert (rows[0]["window_id"], rows[0]["sentiment_compound"]) == (1, c)


def test_later_article_wins_ties(spark):
    s = spark.createDataFrame([("A", 1, 1, 0.4), ("A", 2, 2, -0.4), ("A", 0, 3, 0.1)], "ticker string, ts_us bigint, id bigint, compound double")
    r = windows.news_window_summary(s).first()
    assert (r["best_compound"], r["max_abs_compound"], r["news_count"], r["had_strong_sentiment"]) == (-0.4, 0.4, 3, False)


def test_vwap_fixed_numbers(spark):
    df = spark.createDataFrame([("A", 0, 100.0, 10), ("A", 1, 200.0, 20), ("A", 60_000_000, 5.0, 0)], "ticker string, ts_us bigint, price double, size bigint")
    got = {r["window_start_us"]: r["vwap"] for r in windows.vwap_tumbling(df).collect()}
    assert got == {0: 5000 / 30, 60_000_000: 0.0}


def test_average_path():
    assert list(iforest.average_path(np.array([0, 1, 2]))) == [0, 0, 1]
    assert float(iforest.average_path(np.array(256))) == pytest.approx(10.2448, abs=1e-3)


def test_planted_outliers_rank_first():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 7))
    x[:5] += 12
    model = iforest.grow(x, 100, 256, 1)
    s = iforest.score(x, *model, 256)
    assert set(np.argsort(s)[:5]) == set(range(5))
    assert ((s < 0) & (s >= -iforest.BILLION)).all()


def test_samples_are_different_rows_and_draws_are_even():
    states = iforest.mixed(np.int64(5), np.arange(200, dtype=np.int64))
    for n, psi in ((256, 256), (5000, 256), (300, 256), (7, 7), (1, 1)):
        rows = iforest.sampled(n, psi, states)
        assert rows.min() >= 0 and rows.max() < n
        assert all(len(set(r)) == psi for r in rows.tolist())
    u = iforest.draw(states[:, None], np.arange(5000, dtype=np.int64)) / iforest.PRIME
    assert abs(u.mean() - 0.5) < 0.002 and abs((u < 0.1).mean() - 0.1) < 0.002
    assert abs(np.corrcoef(u[:, :-1].ravel(), u[:, 1:].ravel())[0, 1]) < 0.01
    assert abs(np.corrcoef(u[:-1].ravel(), u[1:].ravel())[0, 1]) < 0.01


def test_trees_split_their_samples():
    """Every leaf's path length is its level plus what its rows still lack."""
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(500, 3)), 1)
    x[:, 2] = 4.0  # never split on
    feature, threshold, value = iforest.grow(x, 20, 64, 9)
    assert (feature < 2).all()
    for tree in range(20):
        rows = {0: x[iforest.sampled(500, 64, iforest.mixed(np.int64(9), np.arange(20)))[tree]]}
        for node in range(feature.shape[1]):
            if node not in rows:
                assert feature[tree, node] == -1 and value[tree, node] == 0
                continue
            level, f = int(np.log2(node + 1)), feature[tree, node]
            if f < 0:
                assert level == 6 or len(rows[node]) == 1 or (rows[node] == rows[node][0]).all()
                assert value[tree, node] == level * iforest.BILLION + iforest.whole(iforest.average_path(np.array(len(rows[node]))))
                continue
            right = rows[node][:, f] > threshold[tree, node]
            assert 0 < right.sum() < len(right)
            rows[2 * node + 1], rows[2 * node + 2] = rows[node][~right], rows[node][right]


@pytest.mark.parametrize("n", [1, 2, 20, 21, 999])
def test_cut_off_is_a_percentile(n):
    s = np.random.default_rng(n).integers(-(10**9), 0, n)
    for share in (0.01, 0.05, 0.5):
        assert iforest.cut_off(s, share) / 1000 == pytest.approx(np.percentile(s, 100 * share), rel=1e-12)


SMALL = anomaly.Forest(window=400, interval=100, warmup=50, trees=25, sample=64, block=2)


def vectors(spark, n=750, parts=3):
    rng = np.random.default_rng(7)
    rows = []
    for t in ("A", "B"):
        x = rng.normal(size=(n, 7))
        x[[i for i in (300, 555) if i < n]] += 15
        rows += [(t, i, i, i + 1, *map(float, x[i])) for i in range(n)]
    ddl = "ticker string, ts_us bigint, seq bigint, ordinal bigint, " + ", ".join(f"{c} double" for c in anomaly.FEATURES_7D)
    return spark.createDataFrame(rows, ddl).repartition(parts)


def test_forest_scores(spark):
    first = {(r["ticker"], r["seq"]): r for r in anomaly.score(vectors(spark), SMALL).collect()}
    again = {(r["ticker"], r["seq"]): r for r in anomaly.score(vectors(spark, parts=5), SMALL).collect()}
    assert len(first) == 1500 and {k: v["score"] for k, v in first.items()} == {k: v["score"] for k, v in again.items()}
    for (t, i), r in first.items():
        assert r["version"] == i // 100
        assert r["warming_up"] == (i < 100) and (not r["warming_up"] or (r["score"] == 0.0 and not r["is_anomaly"]))
    assert all(first[(t, i)]["is_anomaly"] for t in "AB" for i in (300, 555))
    live = [r for r in first.values() if not r["warming_up"]]
    assert 0.01 < sum(r["is_anomaly"] for r in live) / len(live) < 0.2
    flags = anomaly.flagged(anomaly.score(vectors(spark), SMALL)).collect()
    assert all(set(r["features"]) == set(anomaly.FEATURES_7D) and r["model_version"] >= 1 for r in flags)


def test_warm_up_by_default(spark):
    d = anomaly.epochs(spark.range(1200).select(F.lit("A").alias("ticker"), F.col("id").alias("ts_us"), F.col("id").alias("seq")))
    got = {r["ordinal"]: (r["warming_up"], r["epoch"]) for r in d.collect()}
    assert got[499] == (True, 0) and got[500] == (False, 0) and got[1000] == (False, 0) and got[1001] == (False, 1)


def test_training_windows(spark):
    got = {(r["ticker"], r["version"]): r["n"] for r in anomaly.training_counts(vectors(spark), SMALL).collect()}
    assert got == {(t, v): min(v * 100, 400) for t in "AB" for v in range(1, 8)}


def test_saved_versions_are_valid_in_their_time(spark, tmp_path):
    v, root = vectors(spark), str(tmp_path / "m")
    models = anomaly.fit(v, SMALL)
    for part in (models.filter("version <= 3"), models.filter("version in (3, 4, 7)")):  # 5 and 6 are never saved
        anomaly.save(part, root)
    loaded = anomaly.load(spark, root)
    assert loaded.count() == 2 * 5 * 25
    cols = ["version", "raw_score", "score", "is_anomaly", "warming_up"]
    got = {(r["ticker"], r["seq"]): tuple(r[c] for c in cols) for r in anomaly.score_with(v, loaded, SMALL).collect()}
    want = {(r["ticker"], r["seq"]): tuple(r[c] for c in cols) for r in anomaly.score(v, SMALL).collect()}
    assert got.keys() == want.keys()
    for (t, i), g in got.items():
        assert g[0] == (4 if i // 100 in (5, 6) else i // 100)
        assert i // 100 in (5, 6) or g == want[t, i]
    last = anomaly.newest(loaded)
    assert {r["version"] for r in anomaly.score_with(v.filter("ordinal > 700"), last, SMALL).collect()} == {7}
    stranger = v.withColumn("ticker", F.lit("NEW"))
    assert {r["warming_up"] for r in anomaly.score_with(stranger, last, SMALL).collect()} == {True}
