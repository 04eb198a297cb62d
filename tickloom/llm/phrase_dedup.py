"""Substring dedup in words: repeated-phrase automata.

``repeats`` confirms which phrases (strings of ``GRAM`` words) recur across documents and
deals the different passages around them to shards. Each shard compiles its confirmed
phrases into an Aho-Corasick automaton and streams all its passages through it; that
locates the phrases and lines the passages up. Windows of ``LENGTH`` words at one offset from a
phrase are then compared as texts, and each gets the smallest document id it starts in. A
word goes if a window over it also starts in a document with a smaller id.

An automaton holds the phrases of one shard, ``SHARD_WORDS`` words of passages at most, so
it has the same size at any corpus size; a passage goes to the shard of its phrase only.

Defined cases: null texts have no words; texts shorter than a window keep all words;
repeats within one document, and between rows with the same id, stay; a null id counts as
smaller than all others; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame

from tickloom.llm import repeats
from tickloom.llm.common import WORD, arrow_rows

LENGTH = 50
GRAM = 16
SHARD_WORDS = 200_000

_GAPS = np.zeros(256, bool)
_GAPS[[9, 10, 11, 12, 13, 32]] = True


def units_of(text: str) -> np.ndarray:
    """A 64-bit hash of each word."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    gap = _GAPS[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    out = np.empty(len(start), np.uint64)
    done = 0
    while done < len(start):
        # As many words as fit a chunk; a longer word is hashed on its own.
        low = start[done]
        upto = max(done + 1, int(np.searchsorted(end, low + repeats.CHUNK, "right")))
        if end[upto - 1] - low > repeats.CHUNK:
            out[done] = xxhash.xxh3_64_intdigest(raw[low : end[done]].tobytes())
        else:
            prefix = repeats.sums(raw[low : end[upto - 1]])
            out[done:upto] = repeats.of_ranges(prefix, start[done:upto] - low, end[done:upto] - low)
        done = upto
    return out


def phrases(bodies: list[bytes], anchors: list[int], gram: int) -> dict[int, bytes]:
    """The phrase of each anchor, taken from a passage around it."""
    out: dict[int, bytes] = {}
    for body, anchor in zip(bodies, anchors, strict=True):
        if anchor not in out:
            units = units_of(body.decode("utf-8", "surrogatepass"))
            at = int(np.flatnonzero(repeats.grams(units, gram) == np.uint64(anchor & (1 << 64) - 1))[0])
            out[anchor] = b" ".join(body.split(b" ")[at : at + gram])
    return out


def automaton(of_anchor: dict[int, bytes]) -> ahocorasick.Automaton:
    """All phrases, with blanks around so that only whole words match."""
    a = ahocorasick.Automaton()
    for anchor, phrase in of_anchor.items():
        a.add_word(f" {phrase.decode('latin-1')} ", anchor)
    a.make_automaton()
    return a


def _search(length: int, gram: int):
    def search(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["anchor", "piece"]).sort_values(["anchor", "piece"])
        bodies, anchors = rows["body"].tolist(), rows["anchor"].tolist()
        found = automaton(phrases(bodies, anchors, gram))
        # Windows by their offset from the phrase and their text; ids of where they start.
        least: dict[tuple, int] = {}
        keys: list[list[tuple]] = []
        for body, anchor, many, first_id in zip(bodies, anchors, rows["many"], rows["first_id"], strict=True):
            spaces = [-1, *(i for i, c in enumerate(body) if c == 32), len(body)]
            number = {s: i for i, s in enumerate(spaces)}
            mine: list[tuple] = []
            for end, which in found.iter(f" {body.decode('latin-1')} "):
                if which != anchor:
                    continue
                # The blank after the phrase ends it; its words are the gram before that.
                at = number[end - 1] - gram
                for w in range(max(0, at + gram - length), min(many, at + 1)):
                    mine.append((w, (anchor, at - w, body[spaces[w] + 1 : spaces[w + length]])))
            for _, key in mine:
                if least.get(key, first_id) >= first_id:
                    least[key] = first_id
            keys.append(mine)
        out = []
        for anchor, piece, mine in zip(anchors, rows["piece"], keys, strict=True):
            ids: dict[int, int] = {}
            for w, key in mine:
                ids[w] = min(ids.get(w, least[key]), least[key])
            low = high = None
            for w in [*sorted(ids), None]:
                if low is not None and (w is None or w != high or ids[w] != ids[low]):
                    out.append((anchor, piece, low, high, ids[low]))
                    low = None
                if w is not None:
                    low, high = (w if low is None else low), w + 1
        return pd.DataFrame(out, columns=["anchor", "piece", "low", "high", "least"])

    return search


def cut_words(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """doc_id, text and the ranges of words to remove (starts, ends; null for none)."""
    keyed = repeats.keyed(docs, id_col, text_col)

    def cut(text, first, many):
        words = WORD.findall(text.encode("utf-8", "surrogatepass"))
        return [b" ".join(words[f : f + n + length - 1]) for f, n in zip(first, many, strict=True)]

    def windows(body):
        words = body.split(b" ")
        return [xxhash.xxh3_128_digest(b" ".join(words[i : i + length])) for i in range(len(words) - length + 1)]

    how = {"shard_units": SHARD_WORDS, "through": True} | how
    spans = repeats.repeated(keyed, units_of, cut, _search(length, gram), windows, length, gram, True, **how)
    return repeats.attached(keyed, repeats.merged(spans))


def digests(docs: DataFrame, **how) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    ranges = cut_words(docs, **how)

    def row(doc_id, text, starts, ends):
        words = WORD.findall(text.encode("utf-8", "surrogatepass"))
        kept, at = [], 0
        for s, e in zip(starts or (), ends or (), strict=True):
            kept += words[at:s]
            at = e
        kept += words[at:]
        return [(doc_id, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())]

    kind = ranges.schema["doc_id"].dataType.simpleString()
    return arrow_rows(ranges, row, f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string")
