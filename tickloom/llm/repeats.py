"""Where windows of a fixed length repeat: what the two substring operators share.

A document is a sequence of units (bytes or words). Of each window of ``length`` units the
``gram``-unit string with the smallest hash is its anchor (winnowing); neighbouring windows
mostly share one, and together they make a piece. Equal windows have equal anchors at equal
offsets, so a window can only repeat within the pieces of its anchor:

* anchors that occur once are done with;
* where all pieces of an anchor are alike, what holds for one holds for all their windows
  (``through`` has one of them searched all the same);
* only anchors with different pieces, those at the edges of a repeat, need their units
  compared. That is left to the operator's own search, in shards of anchors. An anchor with
  more than ``HOT`` different pieces is not searched in one shard: its windows are grouped
  by digest, in map tasks first.

Documents are scanned twice, and read once more to fetch the pieces to compare and once to
cut. They shuffle only where the table of what to fetch or cut is too large to broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import arrow_rows, only, stored, text_of, within

HOT = 4096
#: Repeated anchors are broadcast up to this size in memory, beyond it they are joined by shuffle.
MAX_ANCHOR_BYTES = 160 << 20
#: Units scanned at once, so that a long document takes bounded memory besides its text.
CHUNK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_LOW = np.uint64((1 << 24) - 1)
#: Rows of a batch that goes to Spark.
_BATCH = 200_000


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = base
    return np.multiply.accumulate(out)


_UP = _powers(CHUNK + 4096, _BASE)
_DOWN = _powers(CHUNK + 4096, np.uint64(pow(int(_BASE), -1, 1 << 64)))


def mixed(h: np.ndarray) -> np.ndarray:
    """Hashes with all bits stirred."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def sums(units: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any range of ``units`` follows."""
    out = np.zeros(len(units) + 1, np.uint64)
    np.cumsum((units.astype(np.uint64) + np.uint64(1)) * _UP[: len(units)], out=out[1:])
    return out


def of_ranges(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the ranges [start, end), equal for equal contents."""
    return mixed((prefix[end] - prefix[start]) * _DOWN[start])


def grams(units: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of all strings of ``gram`` units."""
    p = sums(units)
    n = len(units) - gram + 1
    return mixed((p[gram:] - p[:-gram]) * _DOWN[:n]) if n > 0 else np.empty(0, np.uint64)


def owners(hashes: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all windows over ``wide`` hashes: where they are, the first window each
    one owns, and how many. Of equal hashes in a window the first counts."""
    windows = len(hashes) - wide + 1
    if windows <= 0:
        none = np.empty(0, np.int64)
        return none, none, none
    least = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while size * 2 <= wide:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if wide > size:
        least = np.minimum(least[: size - wide], least[wide - size :])
    at = (least & _LOW).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
    return at[first], first, np.diff(np.append(first, windows))


def scan(units: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor, piece, first window, windows) arrays of a document, a chunk at a time.

    ``piece`` is a digest of the units of the piece and of where its anchor lies.
    """
    windows = len(units) - length + 1
    view = memoryview(np.ascontiguousarray(units)).cast("B")
    width = units.itemsize
    for c in range(0, max(0, windows), CHUNK - length):
        part = units[c : c + CHUNK - 1]
        hashes = grams(part, gram)
        at, first, many = owners(hashes, length - gram + 1)
        offset = at - first
        start = ((first + c) * width).tolist()
        end = ((first + many + length - 1 + c) * width).tolist()
        digest = xxhash.xxh3_64_intdigest
        piece = np.fromiter(map(digest, [view[a:b] for a, b in zip(start, end, strict=True)], offset.tolist()), np.uint64)
        yield hashes[at], piece, first + c, many


def occurrences(docs: DataFrame, units_of: Callable[[str], np.ndarray], length: int, gram: int) -> DataFrame:
    """anchor, piece, _key, _id, first, many: one row per piece of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        rows = 0

        def batch() -> pa.RecordBatch:
            nonlocal held, rows
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            held, rows = [], 0
            kinds = [np.int64] * 4 + [np.int32] * 2
            arrays = [pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(k)) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["anchor", "piece", "_key", "_id", "first", "many"])

        for b in batches:
            for key, number, text in zip(b.column(0), b.column(1), b.column(2), strict=True):
                key, number = key.as_py(), number.as_py()
                for anchor, piece, first, many in scan(units_of(text.as_py()), length, gram):
                    if len(anchor):
                        n = len(anchor)
                        held.append((anchor, piece, np.full(n, key), np.full(n, number), first, many))
                        rows += n
                if rows >= _BATCH:
                    yield batch()
        if rows:
            yield batch()

    return docs.select("_key", "_id", "text").mapInArrow(
        run, "anchor bigint, piece bigint, _key bigint, _id bigint, first int, many int"
    )


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_key (of id and text), doc_id, _id (as a number; the smallest for null) and text."""
    text = text_of(f"`{text_col}`")
    return only(docs, *dict.fromkeys([id_col, text_col])).select(
        F.xxhash64(F.col(f"`{id_col}`"), text).alias("_key"),
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(-(1 << 63))).alias("_id"),
        text.alias("text"),
    )


def fetch(docs: DataFrame, wanted: DataFrame, cut: Callable[[str, list[int], list[int]], list[bytes]], windows) -> DataFrame:
    """``wanted`` (_key, anchor, piece, first, many and more) with ``body``, the units of each piece.

    ``windows`` of None gives whole pieces, else it turns a body into one digest per window.
    """
    rest = [c for c in wanted.columns if c != "_key"]
    per = stored(wanted.groupBy("_key").agg(F.collect_list(F.struct(*rest)).alias("w")), "fetch")
    size = wanted.count() * 64
    per = F.broadcast(per) if size <= 64 << 20 else per.hint("shuffle_hash")
    joined = docs.select("_key", "text").join(per, "_key").select("text", "w")
    body = "body binary" if windows is None else "body array<binary>"
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted.schema if f.name != "_key")

    def row(text, w):
        bodies = cut(text, [x["first"] for x in w], [x["many"] for x in w])
        if windows is not None:
            bodies = [windows(body) for body in bodies]
        return [(*[x[c] for c in rest], body) for x, body in zip(w, bodies, strict=True)]

    return arrow_rows(joined, row, f"{kinds}, {body}", flush=2_000)


def merged(spans: DataFrame) -> DataFrame:
    """_key with starts and ends of the union of its ranges (_key, start, end)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, starts, ends, out = None, [], [], []

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            a, b, c = zip(*rows, strict=True)
            kinds = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip((a, b, c), kinds, strict=True)], names=["_key", "starts", "ends"]
            )

        for b in batches:
            for k, s, e in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if k != key:
                    if starts:
                        out.append((key, starts, ends))
                    key, starts, ends = k, [s], [e]
                elif s <= ends[-1]:
                    ends[-1] = max(ends[-1], e)
                else:
                    starts.append(s)
                    ends.append(e)
            if len(out) >= 5_000:
                yield batch(out)
                out = []
        if starts:
            out.append((key, starts, ends))
        if out:
            yield batch(out)

    ordered = spans.select("_key", "start", "end").repartition("_key").sortWithinPartitions("_key", "start")
    return ordered.mapInArrow(run, "_key bigint, starts array<int>, ends array<int>")


def attached(docs: DataFrame, cuts: DataFrame) -> DataFrame:
    """``docs`` (keyed) with the starts and ends to cut, null where nothing is."""
    cuts = stored(cuts, "cuts")
    size = cuts.agg(F.sum(F.size("starts") * 8 + 48)).first()[0] or 0
    cuts = F.broadcast(cuts) if size <= 64 << 20 else cuts.hint("shuffle_hash")
    return docs.join(cuts, "_key", "left").select("doc_id", "text", "starts", "ends")


def repeated(
    docs: DataFrame,
    units_of: Callable[[str], np.ndarray],
    cut: Callable[[str, list[int], list[int]], list[bytes]],
    search: Callable[[pd.DataFrame], pd.DataFrame],
    windows: Callable[[bytes], list[bytes]],
    length: int,
    gram: int,
    earlier: bool,
    shard_units: int,
    hot: int = HOT,
    through: bool = False,
) -> DataFrame:
    """_key, start, end: ranges of units covered by windows that repeat.

    With ``earlier``, a window must also start in a document of a smaller id; else it must
    start anywhere else. With ``through``, anchors whose pieces are all alike are searched
    as well, by one representative, instead of being decided by their digests. ``search`` gets pieces of one shard of anchors (anchor, piece,
    many, copies, first_id, body), which may come twice, and returns runs of windows
    [low, high) of a piece that repeat, with the smallest id they occur in.
    """
    occ = occurrences(docs, units_of, length, gram)
    seen = occ.groupBy("anchor").agg(
        F.count("*").alias("n"),
        (F.min("piece") != F.max("piece")).alias("mixed"),
        F.min("_id").alias("anchor_id"),
        F.max("_id").alias("last_id"),
    )
    again = seen.filter("anchor_id < last_id" if earlier else "n > 1").select("anchor", "mixed", "anchor_id")
    occ = stored(occ.join(within(stored(again, "anchors"), 104, MAX_ANCHOR_BYTES), "anchor"), "occurrences")
    reach = length - 1
    alike = occ.filter("not mixed")
    alike = alike.filter("_id > anchor_id") if earlier else alike
    edge = occ if through else occ.filter("mixed")
    pieces = stored(
        edge.groupBy("anchor", "piece").agg(
            F.count("*").alias("copies"),
            F.min("_id").alias("first_id"),
            F.min(F.struct("_key", "first", "many")).alias("at"),
        ).select("anchor", "piece", "copies", "first_id", "at.*"),
        "pieces",
    )
    crowded = stored(pieces.groupBy("anchor").count().filter(F.col("count") > hot).select("anchor"), "crowded")
    quiet = pieces
    runs = None
    if crowded.count():
        quiet = pieces.join(crowded, "anchor", "left_anti")
        runs = _by_digest(docs, pieces.join(crowded, "anchor", "left_semi"), cut, windows)
    units = quiet.agg(F.sum(F.col("many") + reach)).first()[0] or 0
    shards = max(1, -(-units // shard_units))
    dealt = fetch(docs, quiet, cut, None).withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    searched = dealt.groupBy("shard").applyInPandas(search, "anchor bigint, piece bigint, low int, high int, least bigint")
    runs = stored(searched if runs is None else searched.unionByName(runs), "runs")
    compared = edge.join(runs, ["anchor", "piece"])
    compared = compared.filter("_id > least") if earlier else compared
    found = compared.select("_key", (F.col("first") + F.col("low")).alias("start"), (F.col("first") + F.col("high") + reach).alias("end"))
    if through:
        return found
    return alike.select("_key", F.col("first").alias("start"), (F.col("first") + F.col("many") + reach).alias("end")).unionByName(found)


def _by_digest(docs: DataFrame, pieces: DataFrame, cut, windows) -> DataFrame:
    """Runs of one window each, for anchors with too many pieces for one shard: windows
    meet by their digests, which are counted in the map tasks first."""
    whole = fetch(docs, pieces, cut, windows).dropDuplicates(["anchor", "piece"])
    flat = stored(
        whole.select("anchor", "piece", "copies", "first_id", F.posexplode("body").alias("low", "digest")), "windows"
    )
    met = flat.groupBy("digest").agg(F.sum("copies").alias("n"), F.min("first_id").alias("least")).filter("n > 1")
    return flat.join(met, "digest").select(
        "anchor", "piece", "low", (F.col("low") + 1).alias("high"), "least"
    )
