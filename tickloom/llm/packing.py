"""Packing token streams into windows by order-preserving dynamic programming.

Documents keep the order of the table. Their ids are laid end to end, in blocks of about
``block_tokens`` that end with a document, and a block is cut into windows of at most
``width`` ids. Cuts may lie at the end of a document (free), at the end of a sentence, or,
where a sentence is long, at any ``hard_step``-th id of it, for rising penalties. The best
cuts have the least padding plus penalties:

    best(j) = penalty(j) + min over i with p(j) - p(i) <= width of best(i) + width - (p(j) - p(i))

The minimum is that of ``best(i) + p(i)`` over a sliding window, kept in a monotone queue,
so the whole table costs a constant per candidate cut.

A block is a run of rows of one input split, so nothing shuffles, and a lost task gives
the same pieces again. Only the last window of a block can be far from full.

Defined cases: a null text is empty, and an empty text is the single end id; an empty
table gives no pieces; repeated rows are packed as often as they occur.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 2048
END_ID = 1
PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,"
    " sequence_id bigint, offset bigint"
)
_STOP, _CLOSE, _SPACE, _WIDE, _LINE = 1, 2, 4, 8, 16
_KIND = np.zeros(256, np.uint8)
_KIND[list(b".!?")] = _STOP
_KIND[list(b"\"')]")] = _CLOSE
_KIND[[*range(9, 14), *range(28, 33)]] = _SPACE
_KIND[10] = _LINE
_KIND[128:] = _WIDE


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Ids of a text by the byte-level BPE vocabulary in ``path`` (a tokenizers JSON file).

    They are those of the tokenizers library as the file sets it up, so the string of an
    added token in a text becomes that token's id. The vocabulary is run by tiktoken, which
    gives the same ids several times faster; texts with such a string, and those it gives up
    on, go through the tokenizers library.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    added = [t["content"] for t in spec.get("added_tokens", ())]
    # Byte-level vocabularies write each byte as one printable character.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
    fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    slow = Tokenizer.from_file(path)
    any_added = re.compile("|".join(map(re.escape, added)) or "(?!)").search

    def encode(text: str) -> np.ndarray:
        if any_added(text):
            return np.array(slow.encode(text, add_special_tokens=False).ids, "<u4")
        try:
            ids = fast.encode_ordinary(text)
        except Exception:  # noqa: BLE001  the fast library gives up on some very long words
            ids = slow.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4")

    return encode


def sentence_ends(data: bytes) -> np.ndarray:
    """Places in a UTF-8 text where a sentence ends.

    That is after a stop and what closes it, if white space follows, and after line ends.
    """
    kind = _KIND[np.frombuffer(data, np.uint8)]
    before, after = kind[:-1], kind[1:]
    found = ((before & (_STOP | _CLOSE)) > 0) & (after >= _SPACE) | (before == _LINE) & (after != _LINE)
    ends = np.flatnonzero(found) + 1
    if (kind[ends - 1] == _CLOSE).any():
        others = np.flatnonzero(kind != _CLOSE)
        last = np.searchsorted(others, ends) - 1
        closed = (last >= 0) & (kind[others[np.maximum(last, 0)]] == _STOP)
        ends = ends[(kind[ends - 1] != _CLOSE) | closed]
    wide = np.flatnonzero((kind[ends] == _WIDE) & (kind[ends - 1] != _LINE))
    if len(wide):
        inside = [not data[e : e + 4].decode("utf-8", "ignore")[:1].isspace() for e in ends[wide].tolist()]
        ends = np.delete(ends, wide[inside])
    return np.append(ends, len(data)) if data.endswith(b"\n") else ends


def boundaries(text: str, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions in ``ids`` where a sentence of ``text`` ends (nearest id at or after it).

    ``sizes[i]`` is the number of bytes of id i.
    """
    ends = sentence_ends(text.encode("utf-8", "surrogatepass"))
    if not len(ends) or not len(ids):
        return np.empty(0, np.int64)
    spots = np.searchsorted(np.cumsum(sizes[ids]), ends, "left") + 1
    return spots[np.diff(spots, prepend=0) > 0]


def cut(candidates: np.ndarray, penalties: np.ndarray, width: int) -> list[int]:
    """The best cuts among ``candidates`` (rising, the first 0, gaps of at most ``width``)."""
    p, extra = candidates.tolist(), penalties.tolist()
    worth, back = [0.0] * len(p), [0] * len(p)  # worth: best(i) + p(i)
    queue: deque[int] = deque([0])
    for j in range(1, len(p)):
        while p[j] - p[queue[0]] > width:
            queue.popleft()
        i = queue[0]
        value = worth[i] + width + extra[j]
        worth[j], back[j] = value, i
        while queue and worth[queue[-1]] >= value:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(p) - 1
    while j:
        cuts.append(p[j])
        j = back[j]
    return cuts[::-1]


def pack_block(
    docs: list[tuple[object, np.ndarray, np.ndarray]],
    first_sequence: int,
    width: int,
    sentence_penalty: float,
    hard_penalty: float,
    hard_step: int,
) -> tuple[list[tuple], int]:
    """Pieces of ``docs`` (id, ids, sentence ends) in order, and the next free sequence."""
    spots, costs, at = [np.zeros(1, np.int64)], [np.zeros(1)], 0
    for _, ids, ends in docs:
        inner = ends[(ends > 0) & (ends < len(ids))]
        spot = np.append(inner, len(ids))
        cost = np.append(np.full(len(inner), sentence_penalty), 0.0)
        # An id inside a sentence is a place to cut only where sentence ends are far apart.
        if np.diff(spot, prepend=0).max() > 4 * hard_step:
            hard = np.setdiff1d(np.arange(hard_step, len(ids), hard_step), inner)
            fence = np.append(0, spot)
            gap = np.searchsorted(fence, hard, "right")
            hard = hard[(fence[gap] - fence[gap - 1]) > 4 * hard_step]
            spot = np.append(spot, hard)
            order = np.argsort(spot, kind="stable")
            spot, cost = spot[order], np.append(cost, np.full(len(hard), hard_penalty))[order]
        spots.append(spot + at)
        costs.append(cost)
        at += len(ids)
    cuts = cut(np.concatenate(spots), np.concatenate(costs), width)
    out, k, begin, at = [], 0, 0, 0
    for doc_id, ids, _ in docs:
        raw, start = ids.astype("<u4", copy=False), 0
        while start < len(ids):
            end = min(len(ids), cuts[k] - at)
            crc = zlib.crc32(raw[start:end].tobytes())
            out.append((doc_id, start, end - start, crc, len(ids), first_sequence + k, at + start - begin))
            if at + end == cuts[k]:
                begin, k = cuts[k], k + 1
            start = end
        at += len(ids)
    return out, first_sequence + k


def pack(
    docs: DataFrame,
    vocabulary: str,
    width: int = WIDTH,
    end_id: int = END_ID,
    block_tokens: int = 1 << 20,
    sentence_penalty: float = 8.0,
    hard_penalty: float = 24.0,
    hard_step: int = 32,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: which ids of a document lie where in which sequence.

    ``vocabulary`` is the path of the tokenizer file, the same on every machine.
    ``sequence_id`` is unique over the table and rises within an input split.
    """
    if 4 * hard_step > width:
        raise ValueError("hard_step must be at most a quarter of the width")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(vocabulary)
        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        # Bytes of each id: a byte is a character in the vocabulary, added tokens are plain text.
        size_of = {i: len(token) for token, i in spec["model"]["vocab"].items()}
        size_of |= {t["id"]: len(t["content"].encode()) for t in spec.get("added_tokens", ())}
        sizes = np.ones(max(size_of) + 1, np.int64)
        sizes[list(size_of)] = list(size_of.values())
        sequence = TaskContext.get().partitionId() << 40
        block: list[tuple] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal sequence, block, held
            rows, sequence = pack_block(block, sequence, width, sentence_penalty, hard_penalty, hard_step)
            block, held = [], 0
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        for b in batches:
            for doc_id, text in zip(b.column(0), b.column(1), strict=True):
                text = text.as_py()
                ids = encode(text)
                ends = boundaries(text, ids, sizes)
                ids = np.append(ids, np.uint32(end_id))
                block.append((doc_id.as_py(), ids, ends))
                held += len(ids)
                if held >= block_tokens:
                    yield close()
        if block:
            yield close()

    names = [c.split()[0] for c in PIECES.split(",")]
    return docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    ).mapInArrow(run, PIECES)
