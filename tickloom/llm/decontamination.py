"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Documents and test items are sequences of lower-case words without punctuation. One pass
over all documents finds every n-gram of an item, with the words around it written as
numbers of item words. Every n-gram that a document shares with an item is a seed of this
pair; around its seeds, the two are aligned locally: an edited or paraphrased copy loses
some words and still scores. Document frequencies of the n-grams over the whole corpus
tell which are rare, and pairs with the rarest seeds go first. A later pair is not aligned
if the words it shares can neither contaminate nor beat the best item so far, which
changes no result; that spares most pairs that only common n-grams make.

A document is contaminated by an item if the alignment reaches ``min_share`` of the score
of a full copy, or that of ``min_words`` words copied.

Items go through in blocks of ``BLOCK_WORDS`` words, so what tasks hold of the benchmark is
bounded at any benchmark size. Documents never shuffle; only frequencies do.

Defined cases: null texts have no words, items shorter than an n-gram match nothing,
rows that repeat an item's id are one item, repeated documents and those with a null id
are each judged, an empty benchmark or table contaminates nothing. Ties between items go to the smallest item id. ``clean`` keeps all columns.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import arrow_rows, fresh, only, stored, text_of, within

_WORD = re.compile(r"[^\W_]+")
GRAM = 3
BLOCK_WORDS = 1 << 20
MIN_SHARE = 0.5
MIN_WORDS = 20
MATCH, MISMATCH, GAP = 2, -1, -1


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """The best local alignment score and the position in ``passage`` where it ends.

    A row of the matrix at a time: gaps along the row are a running maximum.
    """
    ramp = np.arange(len(passage) + 1) * -GAP
    row = np.zeros(len(passage) + 1, np.int64)
    best, end = 0, 0
    for w in item:
        step = np.where(passage == w, MATCH, MISMATCH)
        nxt = np.zeros_like(row)
        nxt[1:] = np.maximum(np.maximum(row[:-1] + step, row[1:] + GAP), 0)
        row = np.maximum.accumulate(nxt + ramp) - ramp
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


class Items:
    """A block of test items as word numbers, with their n-grams sorted for lookup."""

    def __init__(self, items: list[tuple[int, list[str]]], gram: int):
        self.gram = gram
        vocabulary = sorted({w for _, ws in items for w in ws})
        self.number = {w: i for i, w in enumerate(vocabulary)}
        self.base = max(2, len(vocabulary))
        #: By place in an n-gram: the strings of items up to there, where numbers would outgrow 63 bits.
        self.tables: dict[int, np.ndarray] = {}
        self.ids = {i: np.array([self.number[w] for w in ws], np.int64) for i, ws in items}
        span = 1
        for k in range(gram):
            if span * self.base >= 1 << 63:
                parts = [self._strings(ws, k) for ws in self.ids.values()]
                self.tables[k] = np.unique(np.concatenate(parts)) if parts else np.empty(0, np.int64)
                span = max(1, len(self.tables[k]))
            span *= self.base
        found = defaultdict(set)
        for i, ws in self.ids.items():
            for k in self.keys(ws).tolist():
                found[k].add(i)
        self.sorted = np.array(sorted(found), np.int64)
        self.items_of = [sorted(found[k]) for k in self.sorted.tolist()]
        self.longest = max((len(ws) for ws in self.ids.values()), default=0)

    def keys(self, ids: np.ndarray) -> np.ndarray:
        """The n-grams as numbers; negative where a word is in no item."""
        return self._strings(ids, self.gram)

    def _strings(self, ids: np.ndarray, length: int) -> np.ndarray:
        """The strings of ``length`` words at each place of an n-gram, as numbers."""
        n = len(ids) - self.gram + 1
        if n <= 0:
            return np.empty(0, np.int64)
        key, known = np.zeros(n, np.int64), np.ones(n, bool)
        for k in range(length):
            if k in self.tables:  # numbered anew, without what no item holds
                at = np.searchsorted(self.tables[k], key)
                at[at == len(self.tables[k])] = 0
                known &= self.tables[k][at] == key
                key = at
            part = ids[k : k + n]
            known &= part >= 0
            key = np.where(known, key * self.base + part, 0)
        return np.where(known, key, -1)

    def find(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """All words as numbers, positions of known n-grams, and which they are."""
        get = self.number.get
        ids = np.fromiter((get(w, -1) for w in words_of(text)), np.int64)
        keys = self.keys(ids)
        at = np.flatnonzero(keys >= 0)
        if not len(at):
            return None
        which = np.searchsorted(self.sorted, keys[at])
        which[which == len(self.sorted)] = 0
        hit = self.sorted[which] == keys[at]
        return (ids, at[hit], which[hit]) if hit.any() else None


def _passages(ids: np.ndarray, at: np.ndarray, reach: int) -> list[tuple[int, int]]:
    """Ranges of words within ``reach`` of the positions ``at``, joined where they meet."""
    out: list[list[int]] = []
    for p in at.tolist():
        start, end = max(0, p - reach), min(len(ids), p + reach)
        if out and start <= out[-1][1]:
            out[-1][1] = end
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _scan(docs: DataFrame, items: Items, id_col: str, text_col: str) -> DataFrame:
    """Per row: the passages around known n-grams, as word numbers, and the n-grams."""

    def row(key, doc_id, text):
        found = items.find(text)
        if found is None:
            return [(key, doc_id, None, None, None, None)]
        ids, at, which = found
        spans = _passages(ids, at, items.longest + items.gram)
        words = np.concatenate([ids[a:b] for a, b in spans]).astype("<i4").tobytes()
        return [(key, doc_id, [x for s in spans for x in s], words, at.tolist(), which.tolist())]

    text = text_of(f"`{text_col}`")
    slim = only(docs, id_col, text_col).select(_key(text).alias("_key"), F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return arrow_rows(
        slim, row, f"_key bigint, doc_id {kind}, spans array<int>, words binary, at array<int>, grams array<int>", flush=2_000
    )


def _key(text: Column) -> Column:
    """What tells rows of one id (or of none) apart: rows alike in both are alike in all results."""
    return F.xxhash64(text)


def _frequencies(scanned: DataFrame, items: Items) -> np.ndarray:
    """The number of documents that hold each n-gram."""
    counted = scanned.select(F.explode(F.array_distinct("grams")).alias("g")).groupBy("g").count()
    df = np.zeros(len(items.sorted), np.int64)
    for g, n in counted.collect():  # at most one row per n-gram of the block
        df[g] = n
    return df


def _limit(counts: dict[int, int], passage: np.ndarray) -> int:
    """A score no alignment passes: that of all words in common, in any order."""
    held = Counter(passage.tolist())
    return MATCH * sum(min(n, held[w]) for w, n in counts.items())


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    gram: int = GRAM,
    min_share: float = MIN_SHARE,
    min_words: int = MIN_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document row and block of items: _key (of the text), doc_id, n_seeded
    (items that share an n-gram with it), n_items (items that contaminate it), item_id, score
    (share of a full copy), raw, end_word of the best alignment, contaminated."""
    rows = only(benchmark, item_col, text_col).select(F.col(f"`{item_col}`").alias("i"), text_of(f"`{text_col}`").alias("t"))
    rows = rows.filter(F.col("i").isNotNull())
    size = rows.agg(F.sum(F.size(F.split("t", r"\s+")))).first()[0] or 0
    blocks = -(-size // block_words)
    out = None
    for k in range(max(1, blocks)):
        block = rows.filter(F.pmod(F.xxhash64("i"), F.lit(max(1, blocks))) == k).collect()
        part = _matches(docs, [(i, words_of(t)) for i, t in block], gram, min_share, min_words, id_col, text_col)
        part = part.withColumn("_block", F.lit(k)) if blocks > 1 else part
        out = part if out is None else out.unionByName(part)
    return out


def _matches(docs, rows, gram, min_share, min_words, id_col, text_col) -> DataFrame:
    # A repeated item id takes the words of all its rows.
    joined: dict[int, list[str]] = defaultdict(list)
    for i, ws in sorted(rows):
        joined[i] += ws
    items = Items(list(joined.items()), gram)
    scanned = stored(_scan(docs, items, id_col, text_col), "grams")
    df = _frequencies(scanned, items)
    counts = {i: Counter(ws.tolist()) for i, ws in items.ids.items()}

    def row(key, doc_id, spans, words, at, grams):
        places: dict[int, list[int]] = defaultdict(list)
        rarest: dict[int, int] = {}
        for p, g in zip(at or (), grams or (), strict=True):
            for i in items.items_of[g]:
                places[i].append(p)
                rarest[i] = min(rarest.get(i, int(df[g])), int(df[g]))
        if not places:
            return [(key, doc_id, 0, 0, None, 0.0, 0, None, False)]
        known = np.frombuffer(words, "<i4").astype(np.int64)
        offsets = np.cumsum([0] + [b - a for a, b in zip(spans[::2], spans[1::2], strict=True)])
        found = []
        top = 0.0
        for i in sorted(places, key=lambda i: (rarest[i], -len(places[i]), i)):
            item = items.ids[i]
            full = MATCH * len(item)
            best = (0, 0)
            for a, b in _passages(range(spans[-1]), np.array(places[i]), len(item) + gram):
                k = int(np.searchsorted(spans[::2], a, "right")) - 1
                a, b = max(a, spans[2 * k]), min(b, spans[2 * k + 1])
                start = int(offsets[k]) + a - spans[2 * k]
                passage = known[start : start + b - a]
                limit = _limit(counts[i], passage)
                if limit < best[0] or (limit / full < min(min_share, top) and limit < MATCH * min_words):
                    continue
                raw, end = align(item, passage)
                best = max(best, (raw, a + end))
                top = max(top, best[0] / full)
            if best[0]:
                found.append((-best[0] / full, i, best[0], best[1]))
        found.sort()
        bad = [-s >= min_share or raw >= MATCH * min_words for s, _, raw, _ in found]
        order = [x for x, b in zip(found, bad, strict=True) if b] or found
        s, i, raw, end = order[0]
        return [(key, doc_id, len(places), sum(bad), i, -s, raw, end, any(bad))]

    kind = scanned.schema["doc_id"].dataType.simpleString()
    return arrow_rows(
        scanned,
        row,
        f"_key bigint, doc_id {kind}, n_seeded bigint, n_items bigint, item_id bigint, score double, raw bigint,"
        " end_word bigint, contaminated boolean",
    )


def judged(found: DataFrame) -> DataFrame:
    """One row per document row from ``matches``: the block with the best item decides."""
    best = F.max_by(
        F.struct("item_id", "score", "raw", "end_word"),
        F.struct("contaminated", "score", (-F.col("item_id")).alias("i")),
    )
    # A row comes once from each block; rows alike in id and text come as often as they are there.
    block = F.row_number().over(Window.partitionBy("doc_id", "_key", "_block").orderBy(F.lit(0)))
    if "_block" not in found.columns:
        return found.select("doc_id", "contaminated", "n_items", "item_id", "score", "raw", "end_word")
    return (
        found.withColumn("_copy", block)
        .groupBy("doc_id", "_key", "_copy")
        .agg(F.sum("n_items").alias("n_items"), F.max("contaminated").alias("contaminated"), best.alias("b"))
        .select("doc_id", "contaminated", "n_items", "b.*")
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` without contaminated rows; a row without an id is judged by its text too."""
    found = matches(docs, benchmark, id_col=id_col, text_col=text_col, **how).filter("contaminated")
    who, which = fresh(docs, "_gone"), fresh(docs, "_gone_key")
    gone = stored(found.select(F.col("doc_id").alias(who), F.col("_key").alias(which)).distinct(), "dropped")
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(who)) & (_key(text_of(f"`{text_col}`")) == F.col(which))
    return docs.join(within(gone, 24), same, "left_anti")
