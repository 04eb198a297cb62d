"""Substring dedup in bytes: merged Burrows-Wheeler transforms of the places that repeat.

``repeats`` leaves the pieces of text whose windows have to be compared, in shards. A piece
is cut into strings of symbols, one string for each offset modulo ``STEP``; a symbol is
``STEP`` bytes, so each byte of the piece starts one suffix, and ten symbols are a window
of 200 bytes. A shard's pieces are split into blocks, and

1. each block gets the Burrows-Wheeler transform of its strings, and its suffix order;
2. the transforms are merged by refining their interleaving (Holt and McMillan 2014): an
   order by the first t symbols, followed once from each suffix to the one before it, is
   the order by t + 1 symbols. Where neighbours differ for the first time is their common
   prefix, so after ten rounds the runs without a border are the windows that repeat.
   No suffixes are sorted again;
3. the bytes of repeated windows are compared, as symbols are hashes of bytes.

Defined cases: null texts are empty; texts shorter than a window lose nothing; a text that
occurs twice, rows with the same id included, loses all windows in both places; an empty
table gives an empty result. Long runs of one byte have one piece per byte, all alike.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame

from tickloom.llm import repeats
from tickloom.llm.common import arrow_rows

LENGTH = 200
GRAM = 100
STEP = 20
#: Bytes of pieces in a shard, and in a block of it.
SHARD_BYTES = 1 << 20
BLOCK_BYTES = 1 << 18


def units_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Order of the suffixes of strings laid end to end, each ended by a 0; ends are
    smaller than symbols and ordered by their place. By prefix doubling."""
    n = len(symbols)
    ends = symbols == 0
    rank = np.where(ends, np.cumsum(ends) - 1, symbols + int(ends.sum()) - 1).astype(np.int64)
    h = 1
    while True:
        key = rank * (int(rank.max()) + 2)
        # Nothing compares past an end, as all ends differ.
        key[:-h] += rank[h:] + 1
        # Ties share a rank, so their order does not matter until there are none.
        order = np.argsort(key)
        ordered = key[order]
        new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        h *= 2
        if new[-1] == n - 1 or h >= n:
            return order


def transform(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform of the strings (0 before a string's start), and the order."""
    order = suffix_order(symbols)
    return np.where(order > 0, symbols[order - 1], 0), order


def merge(transforms: list[np.ndarray], ends: list[int], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """The interleaving of the transforms by the first ``rounds`` symbols, as the number
    of the transform each row comes from, and the block of equal prefixes of each row."""
    total = sum(map(len, transforms))
    source = np.repeat(np.arange(len(transforms)), [len(t) for t in transforms]).astype(np.uint8)
    first = np.repeat(np.arange(len(ends)), ends).astype(np.uint8)
    m = len(first)
    block = np.zeros(total, np.int64)
    before = np.empty(total, np.int64)
    place = np.arange(total)
    for _ in range(rounds):
        for k, t in enumerate(transforms):
            before[source == k] = t
        # A stable order by symbol, as one sort of symbol and place in a number. Rows with
        # 0 before them are whole strings: no suffix follows from them.
        order = np.sort(before << 32 | place)[m:] & 0xFFFFFFFF
        symbol, prefix = before[order], block[order]
        source = np.concatenate([first, source[order]])
        border = np.ones(total, bool)
        border[m + 1 :] = (symbol[1:] != symbol[:-1]) | (prefix[1:] != prefix[:-1])
        block = np.cumsum(border) - 1
    return source, block


def repeated_windows(bodies: list[bytes], length: int = LENGTH, step: int = STEP, block_bytes: int = BLOCK_BYTES) -> list[np.ndarray]:
    """For each body, where windows start that also start elsewhere in ``bodies``."""
    if length % step:
        raise ValueError("the window must be a whole number of symbols")
    # Symbols of all bodies: hashes of the step bytes from each position.
    hashes = [repeats.grams(np.frombuffer(b, np.uint8), step) for b in bodies]
    bounds = np.cumsum([0] + [len(h) for h in hashes])
    _, numbers = np.unique(np.concatenate(hashes), return_inverse=True)
    numbers = (numbers + 1).astype(np.int32)
    blocks: list[list[int]] = [[]]
    size = 0
    # The number of a block is one byte, so blocks grow where a shard is large.
    block_bytes = max(block_bytes, -(-sum(map(len, bodies)) // 250))
    for i, b in enumerate(bodies):
        if size + len(b) > block_bytes and blocks[-1]:
            blocks.append([])
            size = 0
        blocks[-1].append(i)
        size += len(b)
    transforms, places, ends = [], [], []
    for block in blocks:
        symbols, at = [], []
        for i in block:
            place = np.arange(bounds[i], bounds[i + 1])
            for r in range(min(step, len(place))):
                symbols += [numbers[place[r::step]], np.zeros(1, np.int32)]
                at += [place[r::step], np.full(1, -1)]
        bwt, order = transform(np.concatenate(symbols))
        transforms.append(bwt)
        places.append(np.concatenate(at)[order])
        ends.append(len(symbols) // 2)
    source, block = merge(transforms, ends, length // step)
    place = np.empty(len(source), np.int64)
    for k, p in enumerate(places):
        place[source == k] = p
    same = block[1:] == block[:-1]
    rows = np.flatnonzero(np.append(same, False) | np.append(False, same))
    found, interval = place[rows], block[rows]
    good = _confirmed(bodies, bounds, found, interval, length)
    found = np.sort(found[good])
    cuts = np.searchsorted(found, bounds)
    return [found[a:b] - start for a, b, start in zip(cuts[:-1], cuts[1:], bounds[:-1], strict=True)]


def _confirmed(bodies, bounds, found, interval, length) -> np.ndarray:
    """Which of the found windows have an equal one in their interval, byte by byte."""
    text = np.frombuffer(b"".join(bodies), np.uint8)
    starts = np.cumsum([0] + [len(b) for b in bodies])
    body = np.searchsorted(bounds, found, "right") - 1
    at = starts[body] + found - bounds[body]
    head = np.searchsorted(interval, interval)  # the first row of each interval
    good = np.ones(len(found), bool)
    if not len(found):
        return good
    windows = np.lib.stride_tricks.sliding_window_view(text, length)
    for i in range(0, len(found), 1 << 14):
        rows = slice(i, i + (1 << 14))
        good[rows] = (windows[at[rows]] == windows[at[head[rows]]]).all(axis=1)
    for bad in np.unique(interval[~good]):  # symbols that clash: compare texts themselves
        rows = np.flatnonzero(interval == bad)
        texts = [text[at[r] : at[r] + length].tobytes() for r in rows]
        for r, t in zip(rows, texts, strict=True):
            good[r] = texts.count(t) > 1
    return good


def runs_of(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising numbers as runs [low, high)."""
    if not len(starts):
        return starts, starts
    gap = np.flatnonzero(np.diff(starts) > 1)
    return starts[np.append(0, gap + 1)], starts[np.append(gap, len(starts) - 1)] + 1


def _search(length: int):
    def search(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["anchor", "piece"])
        found = repeated_windows(rows["body"].tolist(), length)
        out = []
        columns = zip(rows["anchor"], rows["piece"], rows["copies"], rows["many"], found, strict=True)
        for anchor, piece, copies, many, starts in columns:
            # A piece with copies repeats as a whole.
            low, high = ([0], [many]) if copies > 1 else runs_of(starts)
            out += [(anchor, piece, int(a), int(b), 0) for a, b in zip(low, high, strict=True)]
        return pd.DataFrame(out, columns=["anchor", "piece", "low", "high", "least"])

    return search


def cut_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """doc_id, text and the byte ranges to remove (starts, ends; null for none)."""
    keyed = repeats.keyed(docs, id_col, text_col)

    def cut(text, first, many):
        raw = text.encode("utf-8", "surrogatepass")
        return [raw[f : f + n + length - 1] for f, n in zip(first, many, strict=True)]

    def windows(body):
        return [xxhash.xxh3_128_digest(body[i : i + length]) for i in range(len(body) - length + 1)]

    how = {"shard_units": SHARD_BYTES} | how
    spans = repeats.repeated(keyed, units_of, cut, _search(length), windows, length, gram, False, **how)
    return repeats.attached(keyed, repeats.merged(spans))


def digests(docs: DataFrame, **how) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    ranges = cut_bytes(docs, **how)

    def row(doc_id, text, starts, ends):
        raw = text.encode("utf-8", "surrogatepass")
        kept, at = hashlib.sha256(), 0
        for s, e in zip(starts or (), ends or (), strict=True):
            kept.update(raw[at:s])
            at = e
        kept.update(raw[at:])
        gone = sum(e - s for s, e in zip(starts or (), ends or (), strict=True))
        return [(doc_id, len(raw), gone, len(starts or ()), kept.hexdigest())]

    kind = ranges.schema["doc_id"].dataType.simpleString()
    return arrow_rows(ranges, row, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
