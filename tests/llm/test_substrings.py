"""Both substring dedups against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import phrase_dedup, repeats, suffix_dedup

L = 200


def bytes_of(rows):
    count = {}
    for _, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - L + 1):
            count[b[p : p + L]] = count.get(b[p : p + L], 0) + 1
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - L + 1):
            if count[b[p : p + L]] > 1:
                gone[p : p + L] = b"\1" * L
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def words_of(rows):
    first = {}
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    for i, w in split:
        for p in range(len(w) - 49):
            k = tuple(w[p : p + 50])
            first[k] = min(first.get(k, i), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for p in range(len(w) - 49):
            if first[tuple(w[p : p + 50])] < i:
                gone[p : p + 50] = [True] * 50
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows(prose):
    r = random.Random(7)
    shared = [prose(1000 + i, 60 + 30 * i, 200) for i in range(5)]
    out = [None, "", " \n ", "a" * 700, "ab" * 300, "ü" * 250, shared[0], shared[0], "\t".join(shared[1].split())]
    for i in range(40):
        parts = [prose(i, r.randint(5, 120), 200)]
        for s in r.sample(shared, r.randint(0, 3)):
            w = s.split()
            a, b = sorted(r.sample(range(len(w)), 2))
            parts += [" ".join(w[a:b]), prose(50 + i, r.randint(0, 20), 200)]
        out.append(" ".join(parts))
    # One passage in very many documents with different surroundings.
    out += [f"{prose(500 + i, 8, 200)} {shared[4]} {prose(700 + i, 8, 200)}" for i in range(40)]
    out += [out[20], out[20].replace("a", "b", 1)]
    return list(enumerate(out)) + [(3, "a" * 700)]


@pytest.mark.parametrize(("hot", "shard"), [(4096, 1 << 20), (5, 5_000)])
def test_bytes(texts, rows, hot, shard):
    df = texts(rows, more={"anchor": F.lit(1), "starts": F.lit("x"), "_key": F.lit(2)})
    assert sorted((tuple(r) for r in suffix_dedup.digests(df, hot=hot, shard_units=shard).collect()), key=str) == bytes_of(rows)


@pytest.mark.parametrize(("hot", "shard"), [(4096, 200_000), (5, 2_000)])
def test_words(texts, rows, hot, shard):
    df = texts(rows, more={"anchor": F.lit(1), "many": F.lit("x"), "_id": F.lit(2)})
    assert sorted((tuple(r) for r in phrase_dedup.digests(df, hot=hot, shard_units=shard).collect()), key=str) == words_of(rows)


def test_joins_by_shuffle(texts, rows, monkeypatch):
    monkeypatch.setattr(repeats, "MAX_ANCHOR_BYTES", 0)
    assert sorted((tuple(r) for r in phrase_dedup.digests(texts(rows)).collect()), key=str) == words_of(rows)


def test_chunks_of_long_texts(monkeypatch, prose):
    monkeypatch.setattr(repeats, "CHUNK", 700)
    text = prose(3, 900)
    units = suffix_dedup.units_of(text)
    parts = [p for p in repeats.scan(units, 200, 100)]
    assert len(parts) > 1
    covered = np.concatenate([np.arange(f, f + n) for _, _, first, many in parts for f, n in zip(first, many, strict=True)])
    assert (covered == np.arange(len(units) - 199)).all()
    want = [hash(w) for w in text.split()]
    assert len(set(zip(want, phrase_dedup.units_of(text).tolist(), strict=True))) == len(set(want))


def test_empty_tables_and_null_ids(texts, prose):
    assert suffix_dedup.digests(texts([])).count() == 0 and phrase_dedup.digests(texts([])).count() == 0
    t = prose(1, 80)
    got = {r.doc_id: r.n_removed for r in phrase_dedup.digests(texts([(None, t), (5, t), (6, t)])).collect()}
    assert got == {None: 0, 5: 80, 6: 80}


def test_merged_order_is_the_sorted_order():
    r = random.Random(2)
    strings = [[r.randint(1, 3) for _ in range(r.randint(1, 12))] for _ in range(30)]
    parts = [strings[:9], strings[9:10], strings[10:]]
    made = [suffix_dedup.transform(np.array([x for s in p for x in [*s, 0]], np.int32)) for p in parts]
    source, block = suffix_dedup.merge([m[0] for m in made], [len(p) for p in parts], 4)
    flat = [[x for s in p for x in [*s, 0]] for p in parts]

    def head(k, at):
        out = []
        for x in flat[k][at : at + 4]:
            out.append((x, k, at + len(out)) if x == 0 else (x,))
            if x == 0:
                break
        return out

    used = [0] * len(parts)
    heads = []
    for k in source.tolist():
        heads.append(head(k, int(made[k][1][used[k]])))
        used[k] += 1
    assert heads == sorted(heads)
    assert [a == b for a, b in zip(heads, heads[1:], strict=False)] == (block[1:] == block[:-1]).tolist()
