"""The near_dedup stage of the pipeline against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import near_copies, simhash
from tickloom.llm.common import without


def _set(text):
    w = (text or "").split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def _kept(rows):
    """Ids left by linking every pair of similarity 0.8 or more, and the number of pairs."""
    sets = {i: _set(t) for i, t in rows}
    root = {i: i for i in sets}
    pairs = 0
    for i in sets:
        for j in sets:
            if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                pairs += 1
                a, b = sorted((root[i], root[j]))
                root = {k: a if r == b else r for k, r in root.items()}
    return {i for i, r in root.items() if r == i}, pairs


def _near(r, words, edits):
    words = list(words)
    for k in r.sample(range(len(words)), edits):
        words[k] = f"edit{r.randrange(10**6)}"
    return words


@pytest.mark.parametrize("block", [near_copies.BLOCK_ROWS, 3])
def test_stage_keeps_what_all_pairs_keep(spark, texts, prose, monkeypatch, block):
    monkeypatch.setattr(near_copies, "BLOCK_ROWS", block)
    r = random.Random(11)
    rows = [(i, prose(i, r.randint(1, 150))) for i in range(60)]
    for k in range(80):  # about as far as the threshold, on both sides
        base = prose(500 + k, 200).split()
        rows += [(1000 + 10 * k + j, " ".join(_near(r, base, r.randint(0, 6)))) for j in range(3)]
    chain = prose(900, 200).split()
    for k in range(25):  # neighbours are similar, the ends are not
        rows.append((3000 + (k * 7) % 25, " ".join(chain)))
        chain = _near(r, chain, 2)
    rows += [(4000, None), (4001, ""), (4002, " "), (4003, "one two"), (4004, "one two")]
    want, pairs = _kept(rows)
    out = corpus_pipeline.without_near_copies(spark, texts(rows), "")
    assert pairs > 100 and {x.doc_id for x in out.collect()} == want
    assert out.columns == texts(rows[:1]).columns


def test_stage_finds_its_pairs_by_fingerprints(spark, texts, prose, monkeypatch):
    """Similar texts whose fingerprints lie beyond the radius are not links; without pairs the stage keeps all."""
    base = prose(1, 200).split()
    rows = [(i, " ".join(_near(random.Random(i), base, 2))) for i in range(12)]
    assert near_copies.dedup(texts(rows)).count() == 1
    monkeypatch.setattr(near_copies, "RADIUS", -1)
    assert near_copies.dedup(texts(rows)).count() == 12


def test_radius_holds_similar_sets():
    """Pairs just at the threshold, of all sizes."""
    r = np.random.default_rng(5)
    for n in (4, 8, 16, 40, 200, 1000):
        for _ in range(300):
            both = r.integers(0, 1 << 63, n, dtype=np.uint64)
            x = np.concatenate([both, r.integers(0, 1 << 63, n // 8, dtype=np.uint64)])
            y = np.concatenate([both, r.integers(0, 1 << 63, n // 4 - n // 8, dtype=np.uint64)])
            assert near_copies.similarity(np.unique(x), np.unique(y)) == 0.8
            apart = (simhash.majority(x) ^ simhash.majority(y)).bit_count()
            assert apart <= near_copies.RADIUS


@pytest.mark.parametrize("radius", [2, 24])
def test_vantage_point_search_gives_each_pair_once(monkeypatch, radius):
    monkeypatch.setattr(simhash, "_BRUTE", 64)
    r = np.random.default_rng(radius)
    points = r.integers(0, 1 << 63, 150, dtype=np.uint64)
    points[100:] = points[:50] ^ (np.uint64(1) << r.integers(0, 63, 50, dtype=np.uint64))
    got = [(i, j) for a, b in simhash.near(points, np.ones(150, bool), radius) for i, j in zip(a.tolist(), b.tolist(), strict=True)]
    want = {(i, j) for i in range(150) for j in range(150) if int(points[i] ^ points[j]).bit_count() <= radius}
    assert len(got) == len(set(got)) and set(got) == want


def test_null_ids_stay_and_empty_tables(texts, prose):
    same = prose(1, 50)
    assert near_copies.dedup(texts([(None, same), (None, same), (1, same), (2, same)])).count() == 3
    assert near_copies.dedup(texts([])).count() == 0


def test_a_full_bucket_is_searched_in_blocks(spark, texts, prose, monkeypatch):
    """One bucket of 900 texts in 30 groups that only share its minima: no task gets them all."""
    monkeypatch.setattr(near_copies, "bands", lambda hashes: [1, 2, 3])
    monkeypatch.setattr(near_copies, "BLOCK_ROWS", 100)
    rows = []
    for g in range(30):
        base = prose(g, 60).split()
        rows += [(100 * g + k, " ".join([*base, *[f"x{g}"] * (k % 2)])) for k in range(30)]
    kept = {r.doc_id for r in near_copies.dedup(texts(rows)).collect()}
    assert kept == {100 * g for g in range(30)}


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_rows_without_dropped_ids(spark, texts, limit):
    rows = [(i, f"t{i}") for i in range(2000)] + [(None, "n"), (7, "again")]
    docs = texts(rows, more={"_gone": F.lit("x"), "_gone_": F.lit(1)})
    dropped = spark.range(0, 4000, 3).select(F.col("id").alias("doc_id"))
    out = without(docs, dropped, limit=limit)
    assert out.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in out.collect()) == sorted((str(i), t) for i, t in rows if i is None or i % 3)
    none = spark.range(0).select(F.col("id").alias("doc_id"))
    assert without(docs, none, limit=-1).count() == len(rows)
    assert without(texts([]), dropped, limit=limit).count() == 0
    if not limit:  # only rows that the bits hold are shuffled
        rest = [r.n for r in [out.filter("doc_id % 3 <> 0 OR doc_id IS NULL").agg(F.count("*").alias("n")).first()]]
        assert rest == [sum(i is None or i % 3 != 0 for i, _ in rows)]
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join LeftAnti") == 1 and "Union" in plan.split("\n")[0]
