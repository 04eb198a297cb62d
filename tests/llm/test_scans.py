"""Toxicity, PII and decontamination."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import decontamination, disclosure, toxicity

BAD = ["idiot", "scum", "loser"]


@pytest.fixture(scope="module")
def judged(spark, texts, prose):
    r = random.Random(1)
    rows, labels = [], []
    for i in range(240):
        words = prose(i, 40).split()
        toxic = i % 4 == 0
        if toxic:
            for w in r.sample(BAD, 2):
                words.insert(r.randrange(len(words)), w)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    hidden = ["you 1d10t you", "such s c u m here", "a l0ser indeed", "what an idiiiiot", "$cum all"]
    rows += [(1000 + k, f"{prose(k, 20)} {t} {prose(k + 9, 20)}") for k, t in enumerate(hidden)]
    rows += [(2000, None), (2001, ""), (2002, "x" * 200_000), (2003, "!!! ??? ***"), (2000, None)]
    labels += [(0, 1, 1), (5, 1, None), (None, 1, 1), (99999, 1, 1)]
    kind = "doc_id bigint, quality int, toxic int"
    return texts(rows, more={"score": F.lit("x"), "toxic": F.lit(1)}), spark.createDataFrame(labels, kind), rows


def test_scores_separate_and_restore(judged):
    docs, labels, rows = judged
    got = {r.doc_id: r for r in toxicity.scores(docs, labels).collect()}
    assert all((got[i].score >= 0.7) == (i % 4 == 0) for i in range(240))
    assert [(got[1000 + k].n_restored, got[1000 + k].score >= 0.7) for k in range(5)] == [(1, True)] * 5
    assert len({got[i].score for i in (2000, 2001, 2002, 2003)}) == 1 and got[2000].score < 0.1
    out = toxicity.clean(docs, labels)
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} == {i for i, _ in rows if got[i].score < 0.7}


def test_no_labels_and_empty_tables(spark, texts, judged):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in toxicity.scores(texts(["a", None]), none).collect()} == {0.5}
    assert toxicity.scores(texts([]), judged[1]).count() == 0 and toxicity.clean(texts([]), none).count() == 0


def test_language_model_counts_all_texts(texts, prose):
    rows = [prose(i, 50) for i in range(5)] + [None, "", "É1"]
    want = {}
    for t in rows:
        c = [0, 0, 0, *toxicity.codes((t or "").lower()).tolist()]
        for i in range(len(c) - 3):
            g = ((c[i] * 36 + c[i + 1]) * 36 + c[i + 2]) * 36 + c[i + 3]
            want[g] = want.get(g, 0) + 1
    assert dict(map(tuple, toxicity.count_grams(texts(rows)).collect())) == want


def test_viterbi_is_the_best_path():
    r = random.Random(4)
    lm = np.array([r.random() * 9 for _ in range(36**4)], np.float32)

    def paths(noisy, context=0, last="", cost=0.0, text=""):
        if not noisy:
            yield cost + float(lm[context * 36]), text
            return
        ch, rest = noisy[0], noisy[1:]
        edges = [(ch, 0.05)] if ch.isalpha() else [("", toxicity.COST_DROP)]
        edges += [(x, toxicity.COST_LOOKALIKE) for x in toxicity.LOOKALIKES.get(ch, "")]
        for x, price in edges:
            if x:
                code = toxicity._code(x)
                yield from paths(rest, (context * 36 + code) % 36**3, x, cost + price + float(lm[context * 36 + code]), text + x)
            else:
                yield from paths(rest, context, last, cost + price, text)
        if ch == last:
            yield from paths(rest, context, last, cost + toxicity.COST_REPEAT, text)

    for noisy in ["1d10t", "s.c.um", "aab!", "l0$er", "11"]:
        assert toxicity.decode(noisy, lm) == min(paths(noisy))[1]


PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def _valid(kind, v):
    digits = re.sub(r"[^0-9]", "", v)
    if kind == 1:
        return all(int(p) <= 255 for p in v.split("."))
    if kind == 2:
        twice = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
        return 12 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in twice) % 10 == 0
    return kind != 3 or 9 <= len(digits) <= 15


def test_base_matches_equal_the_patterns():
    r = random.Random(6)
    for _ in range(4000):
        t = "".join(r.choices("ab@.-+ 0123456789()%", k=r.randint(0, 60)))
        want = sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, t) if _valid(k, m.group()))
        assert disclosure.entities(t) == want
    assert disclosure.entities("4111 1111 1111 1111") == [(0, 2, 19)]
    assert disclosure.entities("1" * 200_000) == [] and disclosure.entities("a" * 200_000 + "@") == []


def _revealed(rows, alpha=disclosure.ALPHA, min_docs=disclosure.MIN_DOCS):
    """By the definition: spans of the terms that give an entity of their row away."""
    held, words, spots = [], [], []
    for _, t in rows:
        spans = disclosure.entities(t or "")
        held.append({(k, re.sub(r"[^0-9a-z@.]", "", (t or "")[a:b].lower()) if k != 2 else re.sub(r"\D", "", t[a:b])) for a, k, b in spans})
        mine = [(m[0].lower(), m.start(), m.end()) for m in re.finditer(r"[^\W\d_]{2,}", t or "")]
        words.append({w for w, _, _ in mine})
        spots.append([(w, x, y) for w, x, y in mine if not any(a < y and x < b for a, _, b in spans)])
    out = []
    for es, mine in zip(held, spots, strict=True):
        bad = set()
        for e in es:
            ne = sum(e in h for h in held)
            for w in {w for w, _, _ in mine}:
                net = sum(e in h and any(w == v for v, _, _ in s) for h, s in zip(held, spots, strict=True))
                nt = sum(w in ws for ws in words)
                bits = math.log2(len(rows) / ne)
                if ne >= min_docs and net >= min_docs and bits > 0 and math.log2(len(rows) * net / (ne * nt)) / bits >= alpha:
                    bad.add(w)
        out.append([(x, y) for w, x, y in mine if w in bad])
    return out


def _personal(prose):
    rows = [(i, prose(i, 30)) for i in range(60)]
    rows += [(100 + i, f"Zorblax {prose(200 + i, 300)} mister mail zo@x.org the end, ZORBLAX") for i in range(3)]
    rows += [(110, "Zorblax alone"), (111, None), (112, ""), (113, f"+49 30 1234567 and {prose(1, 20_000)} quuxly"), (114, "quuxly 4111 1111 1111 1111 or +49-30-1234567 zo@x.org")]
    rows += [(115, "only here a@b.cd once")] + [(120 + i, f"the end of {i}") for i in range(40)]
    return rows + [(130, "again zo@x.org mister"), (130, "again zo@x.org mister"), (None, "again zo@x.org mister")]


def test_revealing_terms_follow_the_formula(texts, prose):
    rows = _personal(prose)
    df = texts(rows, more={"base": F.lit(1), "term": F.lit("x"), "_row": F.lit(2), "_key": F.lit(3), "entities": F.lit(4)})
    got = sorted((str(r.doc_id), [(s.start, s.end) for s in r.terms], len(r.base)) for r in disclosure.sanitised(df).collect())
    want = sorted((str(i), marks, len(disclosure.entities(t or ""))) for (i, t), marks in zip(rows, _revealed(rows), strict=True))
    assert got == want
    text = dict(rows)
    marked = {i: {text[int(i)][a:b] for a, b in m} for i, m, _ in got if i != "None"}
    assert {"Zorblax", "ZORBLAX"} <= marked["100"] and "quuxly" in marked["113"] and "the" not in marked["100"]
    assert not marked["110"] and not marked["115"]
    assert disclosure.sanitised(texts([])).count() == 0


@pytest.mark.parametrize("limit", [None, 0])
def test_texts_with_terms_generalised_or_removed(texts, prose, monkeypatch, limit):
    from tickloom.llm import common

    if limit is not None:
        monkeypatch.setattr(common.within, "__defaults__", (limit,))
    rows = _personal(prose)
    df = texts(rows, more={"_spans": F.lit(1), "_marked": F.lit("x")})
    general = disclosure.cleaned(df)
    assert general.columns == df.columns
    got = sorted((str(r.doc_id), r.text) for r in general.collect() if r.text is not None)
    marks = _revealed(rows)
    for i, t in got:
        assert not disclosure.entities(t), i
    of = {i: (t, m) for (i, t), m in zip(rows, marks, strict=True)}
    text = dict(got)
    assert text["114"].startswith("<term> <card> or <phone> <email>") and text["100"].startswith("<term> ") and text["100"].endswith("<term>")
    assert text["110"] == "Zorblax alone" and sum(r.text is None for r in general.collect()) == 1
    removed = {str(r.doc_id): r.text for r in disclosure.cleaned(df, general=False).collect()}
    t, m = of[101]
    spans = sorted([(a, b) for a, _, b in disclosure.entities(t)] + m)
    want, at = "", 0
    for a, b in spans:
        want, at = want + t[at:a], b
    assert removed["101"] == want + t[at:] and "orblax" not in removed["101"]
    assert len(got) + 1 == len(rows) and disclosure.cleaned(texts([])).count() == 0


def test_replaced_spans_may_overlap():
    assert disclosure.replaced("abcdefg", [(1, 4, "ip"), (2, 3, "term"), (3, 5, "card")], True) == "a<ip>fg"
    assert disclosure.replaced("abcdefg", [(0, 1, "ip"), (1, 7, "term")], False) == ""


def _table_score(item, passage):
    h = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    best = 0
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a == b else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment_is_smith_waterman():
    r = random.Random(8)
    for _ in range(200):
        a = [r.randint(0, 4) for _ in range(r.randint(1, 15))]
        b = [r.randint(-1, 4) for _ in range(r.randint(1, 25))]
        assert decontamination.align(np.array(a), np.array(b))[0] == _table_score(a, b)


@pytest.mark.parametrize("block", [50, 1 << 20])
def test_copies_edits_and_clean_documents(spark, texts, prose, block):
    items = [(i, prose(5000 + i, 40, 3000)) for i in range(6)] + [(6, "too short"), (7, None), (None, "x y z w")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").withColumn("score", F.lit(1))
    r = random.Random(9)
    edited = items[1][1].split()
    for k in r.sample(range(40), 7):
        edited[k] = "edited"
    rows = [(i, prose(i, 200)) for i in range(30)]
    rows += [
        (100, f"{prose(61, 50)} {items[0][1].upper()}! {prose(62, 50)}"), (101, f"{prose(63, 20)} {' '.join(edited)}"),
        (102, items[2][1] + " " + items[3][1]), (103, None), (104, ""), (105, " ".join(items[4][1].split()[:25])),
        (106, prose(64, 20_000) + " " + items[5][1]),
    ] + [(200 + i, f"{prose(300 + i, 9)} {items[0][1]}") for i in range(40)]
    df = texts(rows, more={"item_id": F.lit(1), "spans": F.lit("x")})
    found = decontamination.judged(decontamination.matches(df, benchmark, block_words=block))
    got = {x.doc_id: x for x in found.collect()}
    bad = {100: 0, 101: 1, 102: 2, 105: 4, 106: 5} | {200 + i: 0 for i in range(40)}
    assert {i: x.item_id for i, x in got.items() if x.contaminated} == bad
    assert got[100].score == 1.0 and got[102].n_items == 2 and 0.5 <= got[101].score < 1
    out = decontamination.clean(df, benchmark, block_words=block)
    assert out.columns == df.columns and {x.doc_id for x in out.collect()} == {i for i, _ in rows} - set(bad)
    assert decontamination.clean(texts([]), benchmark).count() == 0
    assert decontamination.clean(texts(["a b c d"]), benchmark.limit(0)).count() == 1


@pytest.mark.parametrize("block", [1 << 20, 90])
def test_rows_without_ids_and_repeated_rows_are_each_judged(spark, texts, prose, block):
    items = [(i, prose(5000 + i, 40, 3000)) for i in range(6)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    leaked, clean = f"{prose(1, 30)} {items[0][1]}", prose(2, 60)
    rows = [(None, leaked), (None, clean), (None, None), (1, leaked), (1, leaked), (1, clean), (2, items[0][1] + " " + items[3][1])]
    df = texts(rows, more={"_key": F.lit("x"), "_gone": F.lit(1), "_block": F.lit(2)})
    out = decontamination.clean(df, benchmark, block_words=block)
    assert out.columns == df.columns
    assert sorted(((str(r.doc_id), r.text) for r in out.collect()), key=str) == sorted([("None", clean), ("None", None), ("1", clean)], key=str)
    got = decontamination.judged(decontamination.matches(df, benchmark, block_words=block)).collect()
    assert sorted((str(r.doc_id), r.contaminated, r.n_items) for r in got) == [
        ("1", False, 0), ("1", True, 1), ("1", True, 1), ("2", True, 2), ("None", False, 0), ("None", False, 0), ("None", True, 1),
    ]


@pytest.mark.parametrize("gram", [1, 2, 4, 5, 9])
def test_any_length_of_seeds(spark, texts, prose, gram):
    """60,000 different words, so that an n-gram's number would pass 63 bits from 4 words on."""
    words = [f"w{i}x" for i in range(60_000)]
    items = decontamination.Items([(0, words), (1, words[100:140] + words[:20])], gram)
    assert items.base**gram < 1 << 63 or items.tables
    where = {tuple(ws[k : k + gram]) for ws in (words, words[100:140] + words[:20]) for k in range(len(ws) - gram + 1)}
    r = random.Random(gram)
    text = []
    while len(text) < 3000:
        k = r.randrange(60_000)
        text += [words[k : k + r.randrange(1, 12)], ["other"]][r.random() < 0.1]
    found = items.find(" ".join(text))
    at = set(found[1].tolist()) if found else set()
    assert at == {k for k in range(len(text) - gram + 1) if tuple(text[k : k + gram]) in where}
    number = {}
    for k, which in zip(found[1].tolist(), found[2].tolist(), strict=True):
        assert number.setdefault(which, tuple(text[k : k + gram])) == tuple(text[k : k + gram])
    assert len(set(number.values())) == len(number)


def test_edited_copies_and_excerpts_are_aligned(spark, texts, prose):
    items = [(i, prose(7000 + i, 40, 3000)) for i in range(4)] + [(4, prose(7004, 300, 3000)), (5, "of the best " + prose(7005, 30, 3000))]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    fifth = [" ".join(w if k % 5 != 2 else "edited" for k, w in enumerate(t.split())) for _, t in items]
    excerpt = " ".join(items[4][1].split()[140:160])
    around = [f"{prose(8000 + k, 30)} {{}} {prose(8100 + k, 30)}" for k in range(8)]
    # Items 0 and 4 only as copies that lost words, 1 beside a whole copy, 2 and 3 in one document.
    rows = [(0, around[0].format(fifth[0])), (1, around[1].format(fifth[1])), (2, around[2].format(items[1][1]))]
    rows += [(3, around[3].format(fifth[2] + " " + fifth[3])), (4, around[4].format(excerpt)), (5, around[5].format("of the best"))]
    rows += [(6, around[6].format("of the best") + " " + prose(8200, 300) + " " + fifth[5]), (7, items[4][1]), (8, around[7].format(fifth[0]))]
    rows += [(50 + i, prose(8300 + i, 100) + " of the best") for i in range(30)]
    found = decontamination.judged(decontamination.matches(texts(rows), benchmark)).collect()
    got = {x.doc_id: x for x in found}
    words = decontamination.words_of
    for i, t in rows:
        scores = {k: _table_score(words(b), words(t)) for k, b in items}
        bad = [k for k, b in items if scores[k] >= min(len(words(b)), 40)]
        assert (got[i].contaminated, got[i].n_items) == (bool(bad), len(bad)), i
        if bad:
            assert got[i].item_id in bad and got[i].raw == scores[got[i].item_id]
    assert {i for i in got if got[i].contaminated} == {0, 1, 2, 3, 4, 6, 7, 8} and got[3].n_items == 2


def test_common_disguises_are_restored(spark, texts, prose):
    bad = ["moron", "stupid", "clown", "asshole", "scum"]
    r = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        words = prose(i, 40).split()
        if i % 4 == 0:
            for w in r.sample(bad, 3):
                words.insert(r.randrange(len(words)), w)
        elif i % 4 == 1:
            words += ["such", "a", "loose", "hole", "um", "i", "a"]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 4 == 0)))
    forms = {
        "m 0 r 0 n": 1, "such a m o r o n": 1, "s t u p i d c l o w n": 2, "$(um": 1, "@$$hole": 1, "stuupid": 1,
        "morronn": 1, "you-m0r0n": 1, "cl0wn!": 1, "m.o.r.o.n": 1, "st up id": 1,
        "m    o    r    o    n": 1, "m\n\n\n\n0 \t  r - o    n": 1,
        "such a loose hole": 0, "i a such um": 0, "(um)": 0, "2019-10-05": 0,
    }
    rows += [(1000 + k, f"{prose(k, 20)} {t} {prose(k + 9, 20)}") for k, t in enumerate(forms)]
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = {x.doc_id: x.n_restored for x in toxicity.scores(texts(rows), known).collect()}
    assert {t: got[1000 + k] for k, t in enumerate(forms)} == forms


def test_runs_of_any_length_are_searched_whole(spark, texts, prose):
    """A word whose letters are apart and repeated, in runs of 13 to 5,000 characters."""
    lm = toxicity.language_model(texts([f"{prose(i, 60)} a moron" for i in range(40)]))
    scorer = toxicity.Scorer(lm, {"moron": 3.0, "clown": 2.0}, -1.0)
    for w in (1, 2, 8, 17, 24, 36, 52, 121, 500):
        run = " ".join(c for x in "moron" for c in x * w)
        assert scorer(f"{prose(1, 30)} {run} {prose(2, 30)}")[1:] == (1, 1), w
    assert scorer("455 1 2 3 4 5 6 7")[1] == 0


def test_viterbi_keeps_blanks_and_all_states():
    r = random.Random(5)
    lm = np.array([r.random() * 9 for _ in range(36**4)], np.float32)

    def cost(text, context=0):
        total = 0.0
        for c in text + " ":
            code = toxicity._code(c)
            total += float(lm[context * 36 + code])
            context = (context * 36 + code) % 36**3
        return total

    noisy = "a b1|1|1|1"
    best = {("", 0.0)}
    for ch in noisy:
        edges = [(ch, 0.05)] if ch.isalpha() else [("", toxicity.COST_DROP)]
        edges += [(x, toxicity.COST_LOOKALIKE) for x in toxicity.LOOKALIKES.get(ch, "")] + ([(" ", 0.05)] if ch == " " else [])
        best = {(t + x, p + price) for t, p in best for x, price in edges}
    want = min((p + cost(t), t) for t, p in best)
    assert toxicity.decode(noisy, lm) == want[1]
