"""Packing against an exhaustive search and the tokenizer itself."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tickloom.llm import packing

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _best(p, extra, width):
    best = [0.0] + [float("inf")] * (len(p) - 1)
    for j in range(1, len(p)):
        best[j] = min(best[i] + width - (p[j] - p[i]) + extra[j] for i in range(j) if p[j] - p[i] <= width)
    return best[-1]


def test_cuts_are_optimal():
    r = random.Random(1)
    for _ in range(200):
        p = np.cumsum([0] + [r.randint(1, 9) for _ in range(r.randint(1, 30))])
        extra = np.array([r.choice([0.0, 2.5, 7.0]) for _ in p])
        cuts = packing.cut(p, extra, 20)
        at = {int(x): i for i, x in enumerate(p)}
        whole = [0, *cuts]
        cost = sum(20 - (b - a) + extra[at[b]] for a, b in zip(whole, cuts, strict=False))
        assert cuts[-1] == p[-1] and all(b - a <= 20 for a, b in zip(whole, cuts, strict=False))
        assert abs(cost - _best(p.tolist(), extra.tolist(), 20)) < 1e-9


def test_every_id_lies_in_one_piece(texts, prose):
    long = "word" * 4000
    rows = ["", None, "Hi.", "One. Two!\nThree <|endoftext|> ü", "<|endoftext|>" * 3000, "a<|endoftext|", prose(1, 9000), long, ". ".join(prose(i, 30) for i in range(90)), "Hi."]
    got = packing.pack(texts(rows, more={"start": __import__("pyspark").sql.functions.lit(1)}), VOCABULARY).collect()
    slow = Tokenizer.from_file(VOCABULARY)  # as the file sets it up
    assert 50256 in slow.encode(rows[3], add_special_tokens=False).ids
    for i, t in enumerate(rows):
        ids = np.array(slow.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for p in sorted((r for r in got if r.doc_id == i), key=lambda r: r.start):
            assert p.start == at and p.doc_tokens == len(ids)
            at += p.length
            assert p.ids_crc32 == zlib.crc32(ids[p.start : at].tobytes())
        assert at == len(ids)
    fill = {}
    for r in got:
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in fill.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= packing.WIDTH
    assert packing.pack(texts([]), VOCABULARY).count() == 0


def test_little_padding(texts, prose):
    docs = texts([". ".join(prose(100 * i + k, 12) for k in range(8)) for i in range(150)], parts=1)
    got = packing.pack(docs, VOCABULARY).collect()
    used = sum(r.length for r in got)
    assert used / (len({r.sequence_id for r in got}) * packing.WIDTH) > 0.95


def test_sentence_ends_match_a_pattern():
    ends = re.compile(r"[.!?]+[\"')\]]*(?=\s)|\n+")
    r = random.Random(2)
    parts = ["a", "wo", ".", ".", " ", "\n", "\r\n", '"', "'", "!", "?", ")", "]", "\xa0", "　", "é", "日", "\x1c", "🙂"]
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        want = [len(text[: m.end()].encode()) for m in ends.finditer(text)]
        assert packing.sentence_ends(text.encode()).tolist() == want, text
