"""Near-dedup by word shingles: texts whose shingle sets have a Jaccard similarity of
``SIMILARITY`` or more link, and linked ones form groups.

The method is that of ``simhash``: each text has a fingerprint of its shingles, vantage-point
trees find the fingerprints within ``RADIUS`` bits, and such pairs are confirmed by their
whole shingle sets, so none below the threshold links. Bits of a pair of similarity 0.8
differ with probability 0.152 (0.19 for texts of four or five shingles): 10 +- 3 of 64, and
more than ``RADIUS`` in less than one of 5,000 such pairs of the shortest texts, far fewer
of others.

Unrelated fingerprints lie 32 +- 4 bits apart, so an upper tree would send each of them to
nearly every shard at this radius, and the work would grow with the square of the rows. The
shards are buckets instead: of each text's shingle hashes, ``BANDS`` x ``ROWS`` minima under
different multipliers are taken, and texts that agree in all minima of a band meet in its
bucket. A pair of similarity s meets with probability 1 - (1 - s**ROWS)**BANDS: 0.99997 at
0.8, more above.

A bucket's smallest id is its first vantage point: members within the radius of it are
confirmed against it. Only buckets whose members are then in several groups are searched
with a tree, for pairs across groups: such a bucket is dealt to blocks of about
``BLOCK_ROWS`` members, and a task takes two blocks, so its memory does not grow with the
bucket. It gives at most one edge for each member; pairs within a group need no comparison.

Defined cases: null texts and texts without words have one shingle, the empty one, and
link with each other; texts shorter than a shingle are one shingle; an empty table gives an
empty result. ``dedup`` keeps of each group the smallest id, with all columns; rows with a
null id stay.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import simhash
from tickloom.llm.common import WORD, arrow_rows, only, stored, text_of, within, without
from tickloom.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 24
BANDS, ROWS = 20, 4
BLOCK_ROWS = 4_000
_MULTIPLIERS = np.array([xxhash.xxh64_intdigest(b"%d" % k, 7) | 1 for k in range(BANDS * ROWS)], np.uint64)


def shingles(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """The different shingle hashes of a text, sorted."""
    words = WORD.findall(text.encode("utf-8", "surrogatepass").lower())
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(42)), np.uint64))


def similarity(x: np.ndarray, y: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def bands(hashes: np.ndarray) -> list[int]:
    """The buckets of a set, as signed longs."""
    least = np.full(len(_MULTIPLIERS), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 512):
        np.minimum(least, (hashes[i : i + 512, None] * _MULTIPLIERS).min(axis=0), out=least)
    rows = least.astype("<u8").reshape(BANDS, ROWS)
    keys = np.array([xxhash.xxh64_intdigest(r.tobytes(), k) for k, r in enumerate(rows)], np.uint64)
    return keys.view(np.int64).tolist()


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    slim = only(docs, id_col, text_col).select(F.col(f"`{id_col}`").alias("doc_id"), text_of(f"`{text_col}`").alias("text"))
    return slim.filter("doc_id is not null")


def sets_of(slim: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """doc_id and s, the shingle hashes, of the documents in ``ids``."""
    kind = slim.schema["doc_id"].dataType.simpleString()

    def sets(doc_id, text):
        return [(doc_id, shingles(text, shingle).astype("<u8").tobytes())]

    wanted = within(stored(ids.distinct(), "candidates"), 16)
    return stored(arrow_rows(slim.join(wanted, "doc_id", "left_semi"), sets, f"doc_id {kind}, s binary", flush=500), "shingles")


def confirmed(slim: DataFrame, pairs: DataFrame, shingle: int, least: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose texts are similar."""
    kind = slim.schema["doc_id"].dataType.simpleString()
    of = sets_of(slim, pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")), shingle)
    both = pairs.join(of.select(F.col("doc_id").alias("a"), F.col("s").alias("x")), "a")
    both = both.join(of.select(F.col("doc_id").alias("b"), F.col("s").alias("y")), "b").select("a", "b", "x", "y")

    def judge(a, b, x, y):
        return [(a, b)] if similarity(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")) >= least else []

    return stored(arrow_rows(both, judge, f"a {kind}, b {kind}").distinct(), "similar")


def link(sets: list[np.ndarray], points: np.ndarray, group: np.ndarray, least: float, radius: int) -> list[tuple[int, int]]:
    """Pairs of similar sets with fingerprints ``points`` within ``radius`` that join what is
    in different groups, as few as do."""
    group, out = group.copy(), []
    for a, b in simhash.near(points, np.ones(len(points), bool), radius):
        if (group == group[0]).all():
            break
        apart = (a < b) & (group[a] != group[b])
        for i, j in zip(a[apart].tolist(), b[apart].tolist(), strict=True):
            if group[i] != group[j] and similarity(sets[i], sets[j]) >= least:
                out.append((i, j))
                group[group == group[j]] = group[i]
    return out


def edges(
    docs: DataFrame, shingle: int = SHINGLE, least: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Edges (a, b) that connect all documents whose similar pairs meet in a bucket."""
    slim = _slim(docs, id_col, text_col)
    kind = slim.schema["doc_id"].dataType.simpleString()

    def row(doc_id, text):
        hashes = shingles(text, shingle)
        fp = simhash.majority(hashes)
        return [(doc_id, fp - (1 << 64) if fp >> 63 else fp, bands(hashes))]

    held = arrow_rows(slim, row, f"doc_id {kind}, fp bigint, buckets array<bigint>")
    flat = stored(held.select("doc_id", "fp", F.explode("buckets").alias("bucket")), "buckets")
    vantage = F.min(F.struct("doc_id", "fp")).alias("vantage")
    shared = flat.groupBy("bucket").agg(vantage, F.max("doc_id").alias("last")).filter("vantage.doc_id < last")
    shared = stored(shared.select("bucket", F.col("vantage.doc_id").alias("first"), F.col("vantage.fp").alias("at")), "shared")
    members = stored(flat.join(within(shared, 32), "bucket"), "members")

    inside = F.bit_count(F.col("fp").bitwiseXOR(F.col("at"))) <= RADIUS
    near = stored(members.filter("doc_id <> first").filter(inside).select(F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct(), "pairs")
    found = confirmed(slim, near, shingle, least)
    roots = components(found).select(F.col("a").alias("doc_id"), F.col("b").alias("root"))
    rooted = members.drop("first", "at").join(roots, "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
    rooted = stored(rooted.distinct(), "rooted")
    mixed = rooted.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    rest = stored(rooted.join(mixed.select("bucket"), "bucket"), "mixed")
    of = sets_of(slim, rest.select("doc_id"), shingle)

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        ids = rows["doc_id"].to_numpy()
        points = rows["fp"].to_numpy().view(np.uint64)
        pairs = link([np.frombuffer(x, "<u8") for x in rows["s"]], points, pd.factorize(rows["root"])[0], least, RADIUS)
        return pd.DataFrame({"a": [ids[i] for i, _ in pairs], "b": [ids[j] for _, j in pairs]})

    blocks = F.ceil(F.col("n") / BLOCK_ROWS).cast("int")
    sizes = rest.groupBy("bucket").agg(F.count("*").alias("n")).select("bucket", blocks.alias("blocks"))
    dealt = rest.join(within(stored(sizes, "blocks"), 24), "bucket")
    mine = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    dealt = dealt.select("bucket", "doc_id", "fp", "root", mine.alias("block"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    both = dealt.drop("block", "other").join(of, "doc_id")
    across = both.groupBy("bucket", "low", "high").applyInPandas(search, f"a {kind}, b {kind}")
    return found.unionByName(stored(across.distinct(), "across"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id."""
    found = components(edges(docs, id_col=id_col, text_col=text_col, **how))
    return without(docs, found.select("a").distinct(), id_col)
