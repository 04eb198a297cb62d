"""Phrase counting, rule ensemble, filter audit: brute force, oddities, held-out labels."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import collocations, filter_audit, quality
from tickloom.llm.common import table
from tickloom.llm.reports import op12_rule_ensemble_quality

LABELS = "doc_id bigint, quality int, toxic int"


# --- phrases -------------------------------------------------------------------------


def _pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [[w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def _collocations(rows, least, longest, limit):
    """By the definition, in one place; longer phrases are tried at every length."""
    out = []
    for lang in sorted({x or "und" for x, _ in rows}):
        f, n = Counter(), 0
        for x, text in rows:
            if (x or "und") != lang:
                continue
            for w in _pieces(text):
                n += len(w)
                for k in range(1, longest + 1):
                    f.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = set()
        for p, over in often.items():
            for k in range(2, len(p)):
                covered |= {q for q in (p[i : i + k] for i in range(len(p) - k + 1)) if over >= f[q]}
        found = []
        for p, a in often.items():
            if p not in covered:
                s, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(found)[:limit], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -s))
    return out


def _phrase_rows(seed=1, docs=150):
    r = random.Random(seed)
    words = ["the", "of", "A", "b", "new", "york", "city", "hall", "Ü", "\x00x", "z" * 40, "né"]
    rows = [("en" if i % 3 else None, " ".join(r.choices(words, k=r.randint(0, 40)))) for i in range(docs)]
    rows += [("en", "New York\tCity  Hall. new york; city! hall\x0bnew york\x0ccity hall\rnew"), ("en", None), (None, ""), ("fr", " \t\n")]
    rows += [("en", "to be or not to be " * 30)] * 3 + [("und", "new york city hall " * 500)] * 2
    return rows


def _table(spark, rows, parts=5):
    return spark.createDataFrame(rows, "lang string, text string").repartition(parts).withColumn("n", F.lit(1)).withColumn("key", F.lit("k"))


@pytest.mark.parametrize(("least", "limit", "held"), [(3, 2000, 600_000), (10, 7, 40)])
def test_phrases_equal_brute_force(spark, texts, monkeypatch, least, limit, held):
    # Small bounds: subtrees are spilled, word tables and ids cleared, chunks a few texts.
    monkeypatch.setattr(collocations.phrases, "__defaults__", (held,))
    monkeypatch.setattr(collocations, "FULL", 1.0 if held > 1000 else -1.0)
    rows = _phrase_rows()
    got = collocations.top(_table(spark, rows), least=least, limit=limit).collect()
    assert [tuple(r) for r in sorted(got, key=lambda r: (r.lang, r.rank))] == _collocations(rows, least, 5, limit)


def test_phrases_without_broadcasts_and_with_full_filters(spark, texts, monkeypatch):
    from tickloom.llm import common

    monkeypatch.setattr(common.within, "__defaults__", (0,))
    monkeypatch.setattr(collocations.bit_filter, "__defaults__", (64,))  # nearly every probe is a false hit
    monkeypatch.setattr(collocations, "MAX_BUCKETS", 1)
    monkeypatch.setattr(collocations, "BLOCK", 64)
    rows = _phrase_rows(2, 60)
    got = collocations.top(_table(spark, rows), least=4, longest=3).collect()
    assert [tuple(r) for r in sorted(got, key=lambda r: (r.lang, r.rank))] == _collocations(rows, 4, 3, 2000)


def test_words_with_one_number_get_another_seed(spark, texts, monkeypatch):
    given = collocations.word_counts

    def clash(read, seed):
        out = given(read, seed)
        return out.withColumn("id", F.lit(7).cast("bigint")) if seed == 42 else out

    monkeypatch.setattr(collocations, "word_counts", clash)
    rows = [("en", "a b c a b"), ("en", "a b")]
    assert [tuple(r) for r in collocations.top(_table(spark, rows), least=2).collect()] == _collocations(rows, 2, 5, 2000)


def test_phrases_of_an_empty_table(spark, texts):
    assert collocations.top(_table(spark, []), least=1).count() == 0


@pytest.mark.parametrize("burst", [1, 3, 100])
def test_trie_counts_and_spills_whole_subtrees(burst):
    r = random.Random(burst)
    keys = [b"".join(r.choice([b"A" * 8, b"B" * 8, b"C" * 8]) for _ in range(r.randint(2, 5))) for _ in range(3000)]
    trie = collocations.HatTrie(burst)
    spilled = []
    for i in range(0, len(keys), 100):
        trie.add(keys[i : i + 100], [1 + i % 3] * 100)
        if trie.held > 60:
            run = list(trie.spill(30))
            assert trie.held <= 30
            # Each subtree leaves whole and in key order, and nothing of it is left.
            for got, _ in run:
                assert got == sorted(set(got)) and len({k[:8] for k in got}) == 1 and got[0][:8] not in trie.root
            spilled += run
    spilled += trie.spill(0)
    total, want = Counter(), Counter()
    for got, numbers in spilled:
        for k, n in zip(got, numbers, strict=True):
            total[k] += n
    for i, k in enumerate(keys):
        want[k] += 1 + i // 100 * 100 % 3
    assert trie.held == 0 and not trie.root and total == want


@pytest.mark.parametrize(("limit", "run"), [(1, 7), (50, 7), (10**6, 20_000)])
def test_runs_merge_in_the_order_of_first_keys(spark, texts, monkeypatch, limit, run):
    """Runs of many tries, cut into pieces and merged a few keys at a time."""
    monkeypatch.setattr(collocations, "MERGED", limit)
    monkeypatch.setattr(collocations, "RUN", run)
    r = random.Random(limit)
    total, rows = Counter(), []
    for _ in range(40):
        trie = collocations.HatTrie(5)
        for lang in ("de", "en"):
            keys = [b"".join(bytes([r.randrange(1, 5)]) * 8 for _ in range(r.randint(2, 4))) for _ in range(60)]
            trie.add(keys, [1] * 60)
            total.update((lang, k) for k in keys)
            for got, n in trie.spill(0):
                rows += collocations.runs_of(lang, got, n, 3)
    merges, order = {}, sorted(rows, key=lambda x: (x[:3], x[3]))
    got = {}
    for lang, part, size, first, keys, counts in order:
        merge = merges.setdefault((lang, part, size), collocations.Merge(size, 2))
        for k, n in zip(*merge.add(first, keys, counts), strict=True):
            assert (lang, k) not in got
            got[lang, k] = n
        assert merge.held <= 2 * max(limit, 100) + run
    for (lang, _, _), merge in merges.items():
        for k, n in zip(*merge.finish(), strict=True):
            assert (lang, k) not in got
            got[lang, k] = n
    assert got == {k: n for k, n in total.items() if n >= 2}
    runs = spark.createDataFrame([(a, b, c, bytearray(d), bytearray(e), bytearray(f)) for a, b, c, d, e, f in rows],
                                 "lang string, part int, size int, first binary, keys binary, counts binary")
    assert {(x.lang, bytes(x.key)): x.n for x in collocations.merged(runs, 2).collect()} == got


def test_scores_beyond_64_bits(spark, texts):
    one, two = bytes(8), bytes([1] * 8)
    found = [("en", bytearray(one), 10**12), ("en", bytearray(two), 10**12 - 1), ("en", bytearray(one + two), 10**11 + 7)]
    totals = spark.createDataFrame([("en", 9 * 10**13 + 1)], "lang string, n bigint")
    got = collocations.scored(spark.createDataFrame(found, "lang string, key binary, n bigint"), totals).collect()
    assert [r.score for r in got] == [1000 * (10**11 + 7) * (9 * 10**13 + 1) // (10**12 * (10**12 - 1))]


# --- rules ---------------------------------------------------------------------------


def _by_hand(model, row):
    logit = model.base
    for w, rule in model.rules:
        if all((row[c.name] > c.cut) == c.above for c in rule):
            logit += w
    return 1 / (1 + np.exp(-logit))


def test_rules_as_columns_equal_rules_by_hand(spark, texts):
    d = "/root/testdata/sf0.01"
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    model = quality.learn(docs, labels)
    assert 0 < len(model.rules) < 100
    rows, names = quality.statistics(docs.select("doc_id", "text"), F.col("text"))
    rows = rows.withColumn("score", quality.compiled(model)).collect()
    for r in rows:
        stats = {n: r[f"_s_{n}"] for n in names}
        assert abs(_by_hand(model, stats) - r.score) < 1e-9
    assert {r.doc_id: r.score for r in rows} == {r.doc_id: r.score for r in quality.scores(docs, labels).collect()}


def test_statistics_by_hand(spark, texts):
    rows = [(0, "Ab 12, c!\nc c|"), (1, None), (2, "\n \t"), (3, "x" * 200_000 + " y")]
    out, _ = quality.statistics(texts(rows), F.coalesce("text", F.lit("")))
    got = {r.doc_id: r for r in out.collect()}
    a = got[0]
    assert (a._s_chars, a._s_words, a._s_distinct_words) == (14, 5, 5 / 5)
    assert (a._s_capitals, a._s_digits, a._s_marks, a._s_shouts, a._s_symbols) == (1 / 14, 2 / 14, 1 / 14, 1 / 14, 1 / 14)
    assert (a._s_words_a_line, a._s_distinct_lines) == (5 / 2, 1)
    assert got[1]._s_words == 0 and got[2]._s_words == 0 and got[2]._s_distinct_lines == 1
    assert got[3]._s_chars == 200_002


def test_held_out_quality(spark, texts):
    d = "/root/testdata/sf0.1"
    scored = op12_rule_ensemble_quality(spark, d)
    known = scored.filter("held_out").join(table(spark, d, "labels"), "doc_id").select("score", "predicted", "quality").toPandas()
    good, bad = known[known.quality == 1].score.to_numpy(), known[known.quality == 0].score.to_numpy()
    auc = (good[:, None] > bad[None, :]).mean() + (good[:, None] == bad[None, :]).mean() / 2
    assert len(good) > 500 and auc > 0.98 and (known.predicted == known.quality).mean() > 0.97


def test_labels_held_out_do_not_enter(spark, texts, prose):
    rows = [(i, prose(i, 30) if i % 2 else "| # | # | " * 20) for i in range(60)]
    labels = [(i, i % 2, 0) for i in range(60)]
    held = [r.id for r in spark.range(60).filter("crc32(cast(id as string)) % 3 = 1").collect()]
    flipped = [(i, 1 - q if i in held else q, t) for i, q, t in labels]
    a, b = (
        sorted(map(tuple, quality.scores(texts(rows), spark.createDataFrame(x, LABELS)).collect())) for x in (labels, flipped)
    )
    assert a == b and all((s > 0.5) == (i % 2 == 1) for i, s in a)


def test_quality_of_odd_tables(spark, texts, prose):
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in quality.scores(texts(["a", None, ""]), none).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1, 0) for i in range(9)], LABELS)
    assert all(0.5 < r.score < 1 for r in quality.scores(texts(["a"] * 9), one).collect())
    assert quality.scores(texts([]), one).count() == 0
    # A null id is scored and not learned from; repeated ids and labels, clashing names.
    rows = [(None, "a b"), (1, "a"), (1, "a"), (1, "b")] + [(i, prose(i, 20)) for i in range(2, 30)]
    labels = spark.createDataFrame([(None, 0, 0), (1, 0, 0), (1, 1, 0), (2, None, 0)] + [(i, i % 2, 0) for i in range(3, 30)], LABELS)
    docs = texts(rows, more={n: F.lit("x") for n in ("_text", "_words", "_label", "_id", "score", "quality", "_s_chars")})
    assert quality.scores(docs, labels).count() == len(rows)
    x, y, _ = quality.sample(docs, labels)
    assert len(x) == len(y) == len([i for i in range(1, 30) if i != 2 and __import__("zlib").crc32(str(i).encode()) % 3 != 1])
    x, y, _ = quality.sample(docs, labels, max_rows=4)
    assert len(x) <= 4


def test_lasso_leaves_noise_at_zero():
    rng = np.random.default_rng(1)
    z = rng.normal(size=(400, 30))
    y = (z[:, 0] + 0.1 * rng.normal(size=400) > 0).astype(float)
    w = quality.lasso(z, y, 0.1)
    assert w[1] > 0.5 and np.count_nonzero(w[2:]) <= 3


# --- filters -------------------------------------------------------------------------


def _audit(rows, labels):
    """Each order applied to the documents themselves, one after the other."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs = []
    for i, text, part in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows),
        }
        docs.append((part or "", i, {f for f, x in fails.items() if x}))
    out = {}
    for part in {p for p, _, _ in docs}:
        of = [(i, f) for p, i, f in docs if p == part]
        total = Counter()
        for order in itertools.permutations("ABCDE"):
            left = list(range(len(of)))
            for step, x in enumerate(order, 1):
                gone = [k for k in left if x in of[k][1]]
                redundant = sum(x in f for _, f in of) - len(gone)
                left = [k for k in left if x not in of[k][1]]
                total[x] += len(gone)
                ids = [of[k][0] for k in gone]
                out[part, "".join(order), step] = [
                    len(left), len(gone), redundant, sum(f == {x} for _, f in of),
                    sum(i in good for i in ids), sum(i in toxic for i in ids),
                ]
        for order in itertools.permutations("ABCDE"):
            for step, x in enumerate(order, 1):
                out[part, "".join(order), step].append(total[x])
    return out


def _audit_rows():
    r = random.Random(5)
    kinds = [
        lambda: " ".join(f"w{r.randint(0, 900)}" for _ in range(r.choice([10, 199, 200, 201]))),
        lambda: "same " * r.choice([3, 250]),
        lambda: "LOUD Text " * 120,
        lambda: "a b c # " * r.choice([2, 80]),
        lambda: r.choice([None, "", " \n\x0b", "|", "copy of a text", "Ünï " * 210]),
    ]
    rows = [(i, r.choice(kinds)(), r.choice(["x", "y", None, ""])) for i in range(160)]
    rows += [(900 + i, rows[i][1], "z") for i in range(0, 40)]
    return rows + [(None, "copy of a text", "x"), (None, None, "x"), (7, rows[7][1], "y"), (3, "one more", "x"), (3, "one more", "x")]


def test_audit_equals_filters_applied_in_every_order(spark, texts):
    rows = _audit_rows()
    labels = [(i, int(i % 4 != 0), int(i % 7 == 0)) for i in range(0, 160, 2)] + [(5, None, None), (None, 1, 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    for name in ("id", "mask", "part", "n", "first", "digest", "quality", "state"):
        df = df.withColumn(name, F.lit("x"))
    got = filter_audit.audit(df, spark.createDataFrame(labels, LABELS)).collect()
    assert {(r.part, r.filter_order, r.step): list(r[3:]) for r in got} == _audit(rows, labels)
    assert len(got) == 600 * len({p or "" for _, _, p in rows})


def test_audit_of_an_empty_table(spark, texts):
    assert filter_audit.audit(texts([]), spark.createDataFrame([], LABELS)).count() == 0


@pytest.mark.parametrize("n", [1, 3, 5])
def test_lattice_counts_orders(n):
    letters = "ABCDE"[:n]
    paths = Counter()
    for order in itertools.permutations(letters):
        state = 0
        for x in order:
            paths[state, x] += 1
            state |= 1 << letters.index(x)
    assert {(e.state, e.letter): e.paths for e in filter_audit.lattice(letters)} == dict(paths)


