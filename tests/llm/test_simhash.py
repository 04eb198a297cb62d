"""SimHash groups against all pairs, components against union-find."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tickloom.llm import simhash
from tickloom.llm.components import components


def _roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_fingerprint_bit_by_bit():
    for text in ["one", "one two", "A b C d\te", "é É x y z y z", "same same same same"]:
        w = "".join(c.lower() if c.isascii() else c for c in text).split()
        parts = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
        h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert simhash.fingerprint(text) == want
    assert simhash.fingerprint("") == simhash.fingerprint(" \n") == 0


@pytest.mark.parametrize("shard_rows", [10, 100, 4096])
def test_edges_connect_what_all_pairs_connect(spark, shard_rows):
    r = random.Random(3)
    seeds = [r.getrandbits(64) for _ in range(60)]
    points = set(seeds)
    for s in seeds[:30]:  # chains of near fingerprints
        x = s
        for _ in range(r.randint(1, 25)):
            x ^= 1 << r.randrange(64) | 1 << r.randrange(64)
            points.add(x)
    points = sorted(points)
    arr = np.array(points, np.uint64)
    near = np.argwhere(np.bitwise_count(arr[:, None] ^ arr[None, :]) <= 2)
    want = _roots(len(points), [(int(a), int(b)) for a, b in near if a < b])
    df = spark.createDataFrame([(int(x),) for x in arr.view(np.int64)], "fp bigint").repartition(3)
    found = simhash.edges(df, shard_rows=shard_rows).collect()
    at = {int(x): i for i, x in enumerate(arr.view(np.int64))}
    assert _roots(len(points), [(at[e.a], at[e.b]) for e in found]) == want
    assert len(found) <= 4 * len(points)


def test_components_of_paths_stars_and_loops(spark):
    r = random.Random(5)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 160)] + [(7, 7)]
    pairs += [(r.randrange(200, 260), r.randrange(200, 260)) for _ in range(40)]
    want = _roots(300, pairs)
    got = {x.a: x.b for x in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {i: root for i, root in enumerate(want) if root != i}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_groups_and_dedup(texts, prose):
    base = prose(1, 400)
    near = base.replace(base.split()[200], "changed", 1)
    rows = [(0, base), (1, near), (2, base), (3, prose(2, 300)), (4, None), (5, ""), (6, " "), (None, prose(3, 50)), (8, prose(9, 20_000))]
    df = texts(rows, more={"fp": F.lit("x"), "component_id": F.lit(1), "shard": F.lit(2)})
    got = {r.doc_id: r.component_id for r in simhash.groups(df).collect()}
    assert got[2] == 0 and got[3] == 3 and got[4] == got[5] == got[6] == 4 and got[8] == 8
    d = simhash.fingerprint(base) ^ simhash.fingerprint(near)
    assert got[1] == (0 if d.bit_count() <= 2 else 1)
    out = simhash.dedup(df)
    assert out.columns == df.columns
    assert {r.doc_id for r in out.collect()} == {i for i, c in got.items() if i == c or i is None}
    assert simhash.groups(texts([])).count() == 0 and simhash.dedup(texts([])).count() == 0
