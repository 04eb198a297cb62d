"""Phrases whose words come together far more often than their parts suggest.

Per language, ``n`` counts all word occurrences and f(phrase) all contiguous occurrences
within pieces of text. A candidate has 2 to ``longest`` words and f >= ``least``; cut into
two parts it scores floor(1000 * f * n / (f(first) * f(rest))), and its lowest cut counts.

1. Words are counted in tasks and merged by Spark. A word is known by its XXH64 from here
   on; a seed is used under which no two words of the table share a number.
2. Phrases of known words are counted in buckets by their hash, a byte each that stops at
   255. A phrase in a bucket with less than ``least`` occurrences is not frequent, and
   neither is a longer one that holds it.
3. ``HatTrie`` counts what is left in each task: a shallow trie over the first word ids
   whose leaves are hash containers of the remaining ids. A container that grows too large
   bursts into a branch with smaller ones. When the trie holds too many keys its largest
   subtrees are spilled whole, as runs in key order.
4. ``merged`` deals runs to prefix partitions (a first word and a slice of the ids after it,
   so that a frequent first word spreads) and merges them there in the order of their first
   keys; what lies before the next run's first key is done with, so a task holds what the
   runs at one place have in common, whatever the size of a partition.
   Words and buckets reach the tasks as filters of bits of bounded size. A false hit only
   counts a key in vain, as the exact count decides. Where the corpus outgrows the buckets
   and many of them are full, phrases are counted length by length, each filtered by the
   exact counts of those one word shorter.
5. Cuts, phrases inside longer ones and ranks are joins and aggregates over the frequent
   phrases; products are decimals.

Nulls: a null text is empty, a null language is ``und``. Repeated rows count each. Ties in
the score go to the higher count, then the phrase in UTF-8 byte order. An empty table gives
no rows. Further columns of the input are not looked at.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import Filter, arrow_rows, bit_filter, only, stored, text_of, within

LEAST, LONGEST, TOP = 100, 5, 2000
ID = 8  # bytes of a word id
#: A container with more keys bursts; a task holds so many keys; words it counts or knows at
#: a time; words it works on at once.
BURST, HELD, WORDS, CHUNK = 4_096, 600_000, 300_000, 1 << 20
#: Phrases for each bucket, and buckets in all (64 MB in a task) and in a block that travels; the
#: share of full ones beyond which phrases are counted length by length.
PHRASES_PER_BUCKET, MAX_BUCKETS, BLOCK, FULL = 48, 1 << 26, 1 << 16, 0.1
#: Words for each prefix partition, keys of a run that travel together, and keys merged at once.
WORDS_PER_PREFIX, RUN, MERGED = 2_000_000, 20_000, 400_000

_STOP = b"."  # stands between pieces, and is no word itself
_LOWER = bytearray(range(256))
_LOWER[0x41:0x5B] = bytes(range(0x61, 0x7B))
for _c in b".,;:!?\n\x0b\x0c\r":
    _LOWER[_c] = _STOP[0]
_LOWER = bytes(_LOWER)


def tokens(text: str) -> list[bytes]:
    """The words of a text, with a stop between (and around) its pieces."""
    # What is left of ASCII's white space after the translation is the blank and the tab.
    return (text.encode() + _STOP).translate(_LOWER).replace(_STOP, b" . ").split()


class HatTrie:
    """Counts of strings of word ids (``ID`` bytes each): hash containers under a trie."""

    def __init__(self, burst: int = BURST):
        self.burst, self.held = burst, 0
        self.root: dict[bytes, Box | Branch] = {}

    def add(self, keys: Iterable[bytes], numbers: Iterable[int]) -> None:
        """Add to the counts of keys."""
        root, burst = self.root, self.burst
        for key, n in zip(keys, numbers, strict=True):
            at, depth = root, ID
            box = at.get(key[:depth])
            while box.__class__ is Branch:
                if depth == len(key):  # ends at a burst container
                    break
                at = box.children
                box = at.get(key[depth : depth + ID])
                depth += ID
            if box is None:
                box = at[key[depth - ID : depth]] = Box()
            rest = key[depth:]
            counts = box.counts
            if rest in counts:
                counts[rest] += n
                continue
            counts[rest] = n
            self.held += 1
            if len(counts) > burst and len(rest) > ID and box.__class__ is Box:
                self._burst(at, key[depth - ID : depth], box)

    @staticmethod
    def _burst(at: dict, word: bytes, box: Box) -> None:
        """Put a branch in the place of a container. (One that lacks only the last word of
        its keys stays as it is: each of its children would hold a single key.)"""
        branch = at[word] = Branch()
        for rest, n in box.counts.items():
            if not rest:
                branch.counts[rest] = n
                continue
            child = branch.children.get(rest[:ID])
            if child is None:
                child = branch.children[rest[:ID]] = Box()
            child.counts[rest[ID:]] = n

    def spill(self, keep: int) -> Iterator[tuple[list[bytes], list[int]]]:
        """Take whole subtrees out, the largest first, until at most ``keep`` keys are
        left: the keys of each, in order, and their counts."""
        sizes = {w: box.size() for w, box in self.root.items()}
        for word in sorted(sizes, key=lambda w: (-sizes[w], w)):
            if self.held <= keep:
                return
            box = self.root.pop(word)
            self.held -= sizes[word]
            yield box.run(word)


class Box:
    """A hash container: the rest of each key, and its count."""

    __slots__ = ("counts",)

    def __init__(self):
        self.counts: dict[bytes, int] = {}

    def size(self) -> int:
        return len(self.counts)

    def run(self, prefix: bytes) -> tuple[list[bytes], list[int]]:
        rests = sorted(self.counts)
        return [prefix + r for r in rests], [self.counts[r] for r in rests]


class Branch:
    """A burst container: the next word leads on; ``counts`` has the key that ends here."""

    __slots__ = ("children", "counts")

    def __init__(self):
        self.children: dict[bytes, Box | Branch] = {}
        self.counts: dict[bytes, int] = {}

    def size(self) -> int:
        return len(self.counts) + sum(c.size() for c in self.children.values())

    def run(self, prefix: bytes) -> tuple[list[bytes], list[int]]:
        keys, numbers = [prefix] * len(self.counts), list(self.counts.values())
        for word in sorted(self.children):
            more = self.children[word].run(prefix + word)
            keys += more[0]
            numbers += more[1]
        return keys, numbers


def joined_number(lang: str, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One number of a language's phrase: that of all its words but the last, and the last."""
    salt = np.uint64(xxhash.xxh64_intdigest(lang.encode()))
    mixed = (first ^ salt ^ (second >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + second
    return mixed ^ (mixed >> np.uint64(32))


def _readers(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und"))
    return only(docs, *dict.fromkeys([lang_col, text_col])).select(lang.alias("lang"), text_of(f"`{text_col}`").alias("text"))


def _batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches, ``size`` of them at a time."""
    rows = iter(rows)
    while held := list(islice(rows, size)):
        columns = zip(*held, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str]]:
    for b in batches:
        langs, texts = b.columns
        for i in range(b.num_rows):
            yield langs[i].as_py(), texts[i].as_py()


def word_counts(read: DataFrame, seed: int) -> DataFrame:
    """lang, id, word, n: the occurrences of each word."""
    schema = pa.schema([("lang", pa.string()), ("id", pa.int64()), ("word", pa.string()), ("n", pa.int64())])

    def rows(held: dict[str, Counter]) -> Iterator[tuple]:
        for lang, counts in held.items():
            for w, n in counts.items():
                number = xxhash.xxh64_intdigest(w, seed)
                yield lang, number - (number >> 63 << 64), w.decode(), n
        held.clear()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        for lang, text in _texts(batches):
            counts = held.setdefault(lang, Counter())
            counts.update(tokens(text))
            del counts[_STOP]
            if sum(map(len, held.values())) > WORDS:
                yield from _batches(rows(held), schema)
        yield from _batches(rows(held), schema)

    counted = read.mapInArrow(count, "lang string, id bigint, word string, n bigint")
    return counted.groupBy("lang", "id", "word").agg(F.sum("n").alias("n"))


class Ids(dict):
    """A place in ``numbers`` for each word; place 0 if it can't be frequent, or is a stop."""

    def __init__(self, known: Filter, seed: int):
        self.known, self.seed, self.numbers = known, seed, [0]

    def __missing__(self, word: bytes) -> int:
        number = xxhash.xxh64_intdigest(word, self.seed) if word != _STOP else 0
        place = 0
        if number in self.known and number:
            place = len(self.numbers)
            self.numbers.append(number)
        elif len(self) > WORDS:
            return 0  # words that are not wanted are not all remembered
        self[word] = place
        return place


def _chunks(batches: Iterator[pa.RecordBatch], known: Filter, seed: int) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Language, places of words and their numbers, for about ``CHUNK`` words at a time;
    texts and pieces are parted by zeros."""
    ids = Ids(known, seed)
    held: dict[str, list[np.ndarray]] = {}
    words = 0

    def drained() -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        numbers = np.array(ids.numbers, np.uint64)
        for lang, parts in held.items():
            yield lang, np.concatenate(parts), numbers
        held.clear()

    for lang, text in _texts(batches):
        found = tokens(text)
        held.setdefault(lang, []).append(np.fromiter(map(ids.__getitem__, found), np.int64, len(found)))
        words += len(found)
        if words > CHUNK:
            yield from drained()
            words = 0
            if len(ids) > 2 * WORDS:
                ids = Ids(known, seed)
    yield from drained()


def bucket_filter(read: DataFrame, seed: int, words: Filter, total: int, least: int, longest: int) -> tuple[Filter, float]:
    """A filter of the phrases in buckets with ``least`` occurrences or more, for a corpus of
    ``total`` words, and the share of buckets that are."""
    size = BLOCK
    while size < min(MAX_BUCKETS, total * (longest - 1) / PHRASES_PER_BUCKET):
        size *= 2
    shared = read.sparkSession.sparkContext.broadcast(words)
    mark = min(least, 255)
    schema = pa.schema([("block", pa.int64()), ("counts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.uint8)
        for lang, place, numbers in _chunks(batches, shared.value, seed):
            known, number = place != 0, numbers[place]
            whole, of = known, number
            for length in range(2, longest + 1):
                whole = whole[:-1] & known[length - 1 :]
                of = joined_number(lang, of[:-1], number[length - 1 :])
                at, n = np.unique((of[whole] & np.uint64(size - 1)).astype(np.int64), return_counts=True)
                counts[at] = np.minimum(counts[at] + n, 255)
        blocks = counts.reshape(-1, BLOCK)
        yield from _batches(((int(i), blocks[i].tobytes()) for i in np.flatnonzero(blocks.any(axis=1))), schema, 64)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}  # all blocks of all partitions are MAX_BUCKETS numbers
        for b in batches:
            for block, counts in zip(*b.columns, strict=True):
                held = sums.setdefault(block.as_py(), np.zeros(BLOCK, np.uint16))
                np.minimum(held + np.frombuffer(counts.as_buffer(), np.uint8), 255, out=held)
        bits = ((i, np.packbits(c >= mark, bitorder="little").tobytes()) for i, c in sums.items())
        yield from _batches(bits, schema, 1024)

    kind = "block bigint, counts binary"
    summed = read.mapInArrow(count, kind).repartition("block").mapInArrow(add, kind)
    bits = np.zeros((size // BLOCK, BLOCK // 8), np.uint8)
    for block, packed in zip(*summed.toArrow().columns, strict=True):  # MAX_BUCKETS bits
        bits[block.as_py()] = np.frombuffer(packed.as_buffer(), np.uint8)
    return Filter(bits.ravel().view(np.uint64)), float(np.unpackbits(bits).mean())


def keys_of(
    lang: str, place: np.ndarray, numbers: np.ndarray, filters: dict[int, Filter], low: int, high: int
) -> Iterator[tuple[list[bytes], list[int]]]:
    """The different phrases of ``low`` to ``high`` words among places of words, as keys, and
    how often each occurs. ``filters`` are by length."""
    number = numbers[place]
    packed = number.astype(">u8").tobytes()
    whole, of = place != 0, number  # at i: the words from i on may be a phrase, and its number
    known = place  # at i: the number, in this chunk, of the phrase one word shorter
    for length in range(2, high + 1):
        whole = whole[:-1] & whole[1:]  # both shorter phrases in it
        of = joined_number(lang, of[:-1], number[length - 1 :])
        if length in filters:
            whole &= filters[length].hold(of)
        at = np.flatnonzero(whole)
        code = known[at] * len(numbers) + place[at + length - 1]
        _, first, number_of, n = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
        if length >= low:
            yield [packed[i : i + length * ID] for i in (at[first] * ID).tolist()], n.tolist()
        known = np.zeros(len(place), np.int64)
        known[at] = number_of


#: A run: the keys of one length under a prefix partition, in order, with their counts.
RUNS = pa.schema(
    [("lang", pa.string()), ("part", pa.int32()), ("size", pa.int32()), ("first", pa.binary()), ("keys", pa.binary()), ("counts", pa.binary())]
)


def runs_of(lang: str, keys: list[bytes], counts: list[int], parts: int) -> Iterator[tuple]:
    """Spilled subtrees as runs of each prefix partition."""
    by_size: dict[int, tuple[list[bytes], list[int]]] = {}
    for key, n in zip(keys, counts, strict=True):
        held = by_size.setdefault(len(key), ([], []))
        held[0].append(key)
        held[1].append(n)
    for size, (mine, numbers) in sorted(by_size.items()):
        ids = np.frombuffer(b"".join(mine), ">u8").reshape(len(mine), -1).astype(np.uint64)
        n = np.array(numbers, np.int64)
        prefix = ids[:, 0].copy()
        for k in range(1, min(3, ids.shape[1])):
            prefix = prefix * np.uint64(0x9E3779B97F4A7C15) + (ids[:, k] >> np.uint64(58))
        part = ((prefix ^ (prefix >> np.uint64(31))) % np.uint64(parts)).astype(np.int32)
        for p in np.unique(part).tolist():
            at = np.flatnonzero(part == p)
            at = at[np.lexsort(ids[at].T[::-1])]
            for i in range(0, len(at), RUN):
                rows = at[i : i + RUN]
                packed = ids[rows].astype(">u8").tobytes()
                yield lang, p, size // ID, packed[:size], packed, n[rows].tobytes()


def phrases(
    read: DataFrame, seed: int, words: Filter, filters: dict[int, Filter], lengths: tuple[int, int], parts: int, held: int = HELD
) -> DataFrame:
    """The runs (``RUNS``) of phrases of ``lengths`` words that the tasks' tries spill."""
    shared = read.sparkSession.sparkContext.broadcast((words, filters))
    low, high = lengths

    def spilled(tries: dict[str, HatTrie], keep: int) -> Iterator[tuple]:
        for lang, trie in tries.items():
            keys, counts = [], []
            for more in trie.spill(keep):
                keys += more[0]
                counts += more[1]
            yield from runs_of(lang, keys, counts, parts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, by_length = shared.value
        tries: dict[str, HatTrie] = {}
        for lang, place, numbers in _chunks(batches, known, seed):
            trie = tries.setdefault(lang, HatTrie())
            for keys, n in keys_of(lang, place, numbers, by_length, low, high):
                trie.add(keys, n)
            if sum(t.held for t in tries.values()) > held:
                yield from _batches(spilled(tries, held // (2 * len(tries))), RUNS, 64)
        yield from _batches(spilled(tries, 0), RUNS, 64)

    return read.mapInArrow(count, "lang string, part int, size int, first binary, keys binary, counts binary")


class Merge:
    """Adds up the runs of one prefix partition, which come in the order of their first keys."""

    def __init__(self, size: int, least: int):
        self.size, self.least = size, least
        self.keys, self.counts, self.held = [], [], 0

    def add(self, first: bytes, keys: bytes, counts: bytes) -> tuple[list[bytes], list[int]]:
        """Take a run in; gives the frequent keys that are done with."""
        done = self.finish(first) if self.held > MERGED else ([], [])
        self.keys.append(np.frombuffer(keys, ">u8").reshape(-1, self.size).astype(np.uint64))
        self.counts.append(np.frombuffer(counts, np.int64))
        self.held += len(self.counts[-1])
        return done

    def finish(self, before: bytes | None = None) -> tuple[list[bytes], list[int]]:
        """The frequent keys below ``before``, or all; the rest stays, each key once."""
        if not self.held:
            return [], []
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.lexsort(keys.T[::-1])
        keys, counts = keys[order], counts[order]
        fresh = np.append(True, (keys[1:] != keys[:-1]).any(axis=1))
        starts = np.flatnonzero(fresh)
        keys, counts = keys[starts], np.add.reduceat(counts, starts)
        packed, width = keys.astype(">u8").tobytes(), self.size * ID
        end = len(keys)
        if before is not None:
            end = bisect_left(range(len(keys)), before, key=lambda i: packed[i * width : (i + 1) * width])
        self.keys, self.counts, self.held = [keys[end:]], [counts[end:]], len(keys) - end
        full = np.flatnonzero(counts[:end] >= self.least)
        return [packed[i * width : (i + 1) * width] for i in full.tolist()], counts[full].tolist()


def merged(runs: DataFrame, least: int) -> DataFrame:
    """lang, key, n: the sum of each key over all runs, where it is ``least`` or more."""
    schema = pa.schema([("lang", pa.string()), ("key", pa.binary()), ("n", pa.int64())])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        group, merge = None, None
        for b in batches:
            for row in zip(*b.columns, strict=True):
                lang, part, size, first, keys, counts = (x.as_py() for x in row)
                if group != (lang, part, size):
                    if merge:
                        yield from ((group[0], k, n) for k, n in zip(*merge.finish(), strict=True))
                    group, merge = (lang, part, size), Merge(size, least)
                yield from ((lang, k, n) for k, n in zip(*merge.add(first, keys, counts), strict=True))
        if merge:
            yield from ((group[0], k, n) for k, n in zip(*merge.finish(), strict=True))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(found(batches), schema)

    dealt = runs.repartition("lang", "part", "size").sortWithinPartitions("lang", "part", "size", "first")
    return dealt.mapInArrow(add, "lang string, key binary, n bigint")


def frequent(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text_col: str = "text", lang_col: str = "lang"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words with their ids (lang, id, n, word), totals (lang, n) and the frequent phrases
    of one word up (lang, key, n), all stored."""
    read = _readers(docs, text_col, lang_col)
    seed = 42
    while True:
        words = stored(word_counts(read, seed), "words")
        if words.filter("id = 0").isEmpty() and words.groupBy("lang", "id").count().filter("count > 1").isEmpty():
            break
        seed += 1  # two words share a number: number them anew
    totals = stored(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    known = stored(words.filter(F.col("n") >= least).select("lang", "id", "n", "word"), "known")
    known_words = bit_filter(known.select("id"), known.count())
    total = totals.agg(F.sum("n")).first()[0] or 0
    parts = max(1, total // WORDS_PER_PREFIX)
    buckets, full = bucket_filter(read, seed, known_words, total, least, longest)

    single = known.select("lang", _key(F.col("id")).alias("key"), "n")
    if full <= FULL:
        filters = dict.fromkeys(range(2, longest + 1), buckets)
        return known, totals, stored(single.unionByName(merged(phrases(read, seed, known_words, filters, (2, longest), parts), least)), "phrases")
    found, filters = single, {2: buckets}
    for length in range(2, longest + 1):
        of = stored(merged(phrases(read, seed, known_words, filters, (length, length), parts), least), f"phrases-{length}")
        numbers = arrow_rows(of.select("lang", "key"), lambda lang, key: [(_signed(lang, key),)], "number bigint")
        filters[length] = bit_filter(numbers, of.count())
        found = found.unionByName(of)
    return known, totals, stored(found, "phrases")


def _key(number: Column) -> Column:
    """The bytes of a word id."""
    return F.unhex(F.lpad(F.hex(number), 2 * ID, "0"))


def _signed(lang: str, key: bytes) -> int:
    """The number of a phrase's key, as Spark's signed one."""
    ids = np.frombuffer(key, ">u8").astype(np.uint64)
    of = ids[:1]
    for k in range(1, len(ids)):
        of = joined_number(lang, of, ids[k : k + 1])
    return int(of.view(np.int64)[0])


def scored(found: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, key, a, l, r, n, score of the candidates that no longer one covers."""
    size = F.length("key") / ID
    found = found.withColumn("size", size.cast("int"))
    candidates = found.filter("size > 1").withColumnRenamed("n", "a")
    # A covering candidate occurs as often, so the one that is a single word longer does too.
    longer = candidates.filter("size > 2")
    inside = longer.select(
        "lang",
        F.explode(F.array(F.expr(f"substring(key, 1, length(key) - {ID})"), F.expr(f"substring(key, {ID + 1})"))).alias("key"),
        F.col("a").alias("over"),
    )
    inside = inside.groupBy("lang", "key").agg(F.max("over").alias("over"))
    left = candidates.join(inside, ["lang", "key"], "left").filter("over IS NULL OR over < a").drop("over")

    counts = within(found.select("lang", F.col("key").alias("part"), F.col("n").alias("f")), 160)
    cuts = left.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumns(
        {"first": F.expr(f"substring(key, 1, k * {ID})"), "rest": F.expr(f"substring(key, k * {ID} + 1)")}
    )
    for side, name in (("first", "l"), ("rest", "r")):
        by = counts.withColumnsRenamed({"part": side, "f": name})
        cuts = cuts.join(by, ["lang", side])
    cuts = cuts.join(F.broadcast(totals) if totals.count() <= 10_000 else totals, "lang")

    def whole(name: str) -> Column:
        return F.col(name).cast("decimal(19,0)")

    above, below = (F.lit(1000).cast("decimal(4,0)") * whole("a")) * whole("n"), whole("l") * whole("r")
    rest = above % below
    cuts = cuts.withColumn("score", ((above - rest) / below).cast("long"))  # exact: a whole quotient
    best = cuts.groupBy("lang", "key", "a").agg(F.min(F.struct("score", "k", "l", "r", "n")).alias("m"))
    return best.select("lang", "key", "a", "m.l", "m.r", "m.n", "m.score")


def top(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    limit: int = TOP,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The first ``limit`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    known, totals, found = frequent(docs, least, longest, text_col, lang_col)
    rows = scored(found, totals)
    # By slices of a language first, so that no task ranks a whole one; ties stay in.
    best = [F.col("score").desc(), F.col("a").desc()]
    slices = Window.partitionBy("lang", F.pmod(F.xxhash64("key"), F.lit(256))).orderBy(*best)
    rows = rows.withColumn("place", F.rank().over(slices)).filter(F.col("place") <= limit)
    rows = rows.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*best))).filter(F.col("place") <= limit)
    rows = stored(rows.drop("place"), "best")

    ids = F.expr(f"transform(sequence(0, cast(length(key) / {ID} as int) - 1), i -> substring(key, i * {ID} + 1, {ID}))")
    spread = rows.select("lang", "key", F.posexplode(ids).alias("at", "one"))
    named = within(spread, 160).join(known.select("lang", _key(F.col("id")).alias("one"), "word"), ["lang", "one"])
    of = named.groupBy("lang", "key").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("of"))
    written = of.select("lang", "key", F.array_join("of.word", " ").alias("phrase"))
    whole = rows.join(written, ["lang", "key"])
    order = Window.partitionBy("lang").orderBy(*best, "phrase")
    ranked = whole.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
