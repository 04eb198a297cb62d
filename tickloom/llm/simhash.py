"""SimHash near-dedup with vantage-point trees.

A fingerprint has 64 bits, each the majority of that bit over the hashes of all word
shingles. Fingerprints within ``radius`` bits link, and linked ones form groups.

Distinct fingerprints are dealt to shards by a vantage-point tree: a node holds a
fingerprint v and a distance mu, and sends x inside if d(x, v) <= mu, else outside. By the
triangle inequality everything within r of x lies inside unless d > mu - r, and outside
unless d <= mu + r, so x also queries the shards across a boundary it is near to; each
pair is looked for in one direction only. A shard searches its pairs exactly with a tree
of its own and returns at most one edge per fingerprint (a spanning forest), never all
pairs. Edges are joined to components in Spark.

The upper tree is made from a sample: ``SAMPLE_PER_SHARD`` fingerprints for each shard,
``MAX_SHARDS`` shards at most, so at most a million fingerprints or 8 MB reach the driver.
It only decides where fingerprints meet; every one of them is indexed and results are
exact.

Defined cases: null texts and texts without words have fingerprint 0 and link like any
others, texts shorter than a shingle are one shingle, copies share a fingerprint and are
indexed once, an empty table gives an empty result. ``dedup`` keeps of each group the
smallest id, with all columns; rows with a null id stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import WORD, arrow_rows, only, stored, text_of, within, without
from tickloom.llm.components import components

SHINGLE = 3
RADIUS = 2
SHARD_ROWS = 4096
SAMPLE_PER_SHARD = 16
MAX_SHARDS = 1 << 16
#: Within a shard, this many comparisons are made at once without further splits.
_BRUTE = 1 << 18


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The SimHash of a text as an unsigned number."""
    words = WORD.findall(text.encode("utf-8", "surrogatepass").lower())
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))
    return majority(np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(42)), np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half the hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(hashes[i : i + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint16)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row."""

    def row(doc_id, text):
        fp = fingerprint(text, shingle)
        return [(doc_id, fp - (1 << 64) if fp >> 63 else fp)]

    slim = only(docs, id_col, text_col).select(F.col(f"`{id_col}`").alias("doc_id"), text_of(f"`{text_col}`").alias("text"))
    return arrow_rows(slim, row, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, fp bigint")


def distances(points: np.ndarray, to: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ to).astype(np.int64)


def _vantage(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """The point, of a few, whose distances spread most, and their median; None if all
    points are alike."""
    few = points[:: max(1, len(points) // 256)]
    spread, best = max(((distances(few, v).std(), i) for i, v in enumerate(few[:: max(1, len(few) // 8)])), default=(0, 0))
    if not spread:
        return None
    v = few[:: max(1, len(few) // 8)][best]
    d = distances(points, v)
    mu = int(np.median(d))
    return (v, mu) if (d > mu).any() else (v, mu - 1)


def grow(sample: np.ndarray, shards: int) -> list[tuple]:
    """The upper tree as nodes (vantage, mu, inside, outside); a negative child -k-1 is
    shard k. With a single shard the tree is empty."""
    nodes: list[tuple] = []
    count = 0

    def node(points: np.ndarray, want: int) -> int:
        nonlocal count
        split = _vantage(points) if want > 1 and len(points) > 1 else None
        if split is None:
            count += 1
            return -count
        v, mu = split
        d = distances(points, v)
        at = len(nodes)
        nodes.append(())
        inside = node(points[d <= mu], want // 2)
        outside = node(points[d > mu], want - want // 2)
        nodes[at] = (v, mu, inside, outside)
        return at

    node(sample, shards)
    return nodes


def route(nodes: list[tuple], points: np.ndarray, radius: int) -> list[tuple[int, np.ndarray]]:
    """Shards with the indices of the points that belong there or query them."""
    if not nodes:
        return [(0, np.arange(len(points)))]
    out, todo = [], [(0, np.arange(len(points)))]
    while todo:
        at, index = todo.pop()
        if not len(index):
            continue
        if at < 0:
            out.append((-at - 1, index))
            continue
        v, mu, inside, outside = nodes[at]
        d = distances(points[index], v)
        todo.append((inside, index[d <= mu + radius]))
        todo.append((outside, index[d > mu - radius]))
    return out


def join_into(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Roots of all nodes after linking ``i`` with ``j``; ``parent`` has the roots before."""
    while True:
        a, b = parent[i], parent[j]
        apart = a != b
        if not apart.any():
            return parent
        np.minimum.at(parent, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (parent[parent] != parent).any():
            parent = parent[parent]


def near(points: np.ndarray, home: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within ``radius`` by a vantage-point tree, as arrays of indices: one at home, and any."""
    todo = [(np.flatnonzero(home), np.arange(len(points)))]
    while todo:
        mine, theirs = todo.pop()
        if not len(mine) or not len(theirs):
            continue
        split = _vantage(points[mine]) if len(mine) * len(theirs) > _BRUTE and len(mine) > 8 else None
        if split is None:
            step = max(1, _BRUTE // len(mine))
            for k in range(0, len(theirs), step):
                some = theirs[k : k + step]
                a, b = np.nonzero(np.bitwise_count(points[mine][:, None] ^ points[some][None, :]) <= radius)
                yield mine[a], some[b]
            continue
        v, mu = split
        d, e = distances(points[mine], v), distances(points[theirs], v)
        todo.append((mine[d <= mu], theirs[e <= mu + radius]))
        todo.append((mine[d > mu], theirs[e > mu - radius]))


def link(points: np.ndarray, home: np.ndarray, radius: int) -> np.ndarray:
    """For each point the smallest index of a point linked to it, through pairs within
    ``radius`` of which at least one is at home."""
    parent = np.arange(len(points))
    for i, j in near(points, home, radius):
        parent = join_into(parent, i, j)
    return parent


def edges(distinct: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges (a, b) that connect all fingerprints in ``distinct.fp`` within ``radius``."""
    n = distinct.count()
    shards = min(MAX_SHARDS, -(-n // shard_rows))
    drawn = distinct.orderBy(F.xxhash64("fp"), "fp").limit(shards * SAMPLE_PER_SHARD if shards > 1 else 0)
    sample = np.array([r[0] for r in drawn.select("fp").collect()], np.int64).view(np.uint64)
    nodes = grow(sample, shards)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            points = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            home = np.zeros(len(points), np.int64)
            for shard, index in _homes(nodes, points):
                home[index] = shard
            for shard, index in route(nodes, points, radius):
                # A pair across shards is looked for in the later of the two.
                index = index[home[index] <= shard]
                if len(index):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(index), shard, np.int64)),
                            pa.array(points[index].view(np.int64)),
                            pa.array(home[index] == shard),
                        ],
                        names=["shard", "fp", "home"],
                    )

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        points = rows["fp"].to_numpy().view(np.uint64)
        roots = link(points, rows["home"].to_numpy(bool), radius)
        linked = roots != np.arange(len(points))
        return pd.DataFrame({"a": points[linked].view(np.int64), "b": points[roots[linked]].view(np.int64)})

    dealt = distinct.select("fp").mapInArrow(deal, "shard bigint, fp bigint, home boolean")
    return dealt.groupBy("shard").applyInPandas(search, "a bigint, b bigint")


def _homes(nodes: list[tuple], points: np.ndarray) -> list[tuple[int, np.ndarray]]:
    if not nodes:
        return [(0, np.arange(len(points)))]
    out, todo = [], [(0, np.arange(len(points)))]
    while todo:
        at, index = todo.pop()
        if at < 0:
            out.append((-at - 1, index))
            continue
        v, mu, inside, outside = nodes[at]
        d = distances(points[index], v)
        todo.append((inside, index[d <= mu]))
        todo.append((outside, index[d > mu]))
    return out


def groups(
    docs: DataFrame,
    radius: int = RADIUS,
    shingle: int = SHINGLE,
    shard_rows: int = SHARD_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest linked id) of every row."""
    fps = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(edges(distinct, radius, shard_rows)).select(F.col("a").alias("fp"), F.col("b").alias("root"))
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fp = stored(rooted.join(smallest, "root").select("fp", "component_id"), "components")
    return fps.join(within(of_fp, 24), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id."""
    found = groups(docs, id_col=id_col, text_col=text_col, **how)
    return without(docs, found.filter("doc_id <> component_id").select("doc_id").distinct(), id_col)
