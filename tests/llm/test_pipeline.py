"""The pipeline against its stages' own rules on the small table, and against planted cases
judged here from the definitions."""

import random
import re
import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from tickloom.llm import exact_dedup, queries, toxicity
from tickloom.llm.common import table

D = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = table(spark, D, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
    scores = {r.doc_id: r.score for r in toxicity.scores(docs, table(spark, D, "labels")).collect()}
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, D)
        assert out.columns == docs.columns
        before, after = ({r.doc_id for r in x.select("doc_id").collect()} for x in (now, out))
        assert after <= before
        if name == "toxicity":
            assert after == {i for i, s in scores.items() if s < toxicity.THRESHOLD}
        if name == "exact_dedup":
            kept = {r.doc_id for r in exact_dedup.classes(now).filter("kept").collect()}
            assert after == kept
        now = spark.createDataFrame(out.collect(), docs.schema)
    pieces = corpus_pipeline.run(spark, D)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in now.collect()}


def test_one_query_for_each_operator():
    names = list(queries.load())
    assert "pipeline" in names
    assert {int(n.split("_")[0][2:]) for n in names if n.startswith("op")} == set(range(1, 14))


def _table_score(item, passage):
    """Smith-Waterman by the whole table."""
    row, best = [0] * (len(passage) + 1), 0
    for a in item:
        before, row = row, [0]
        for j, b in enumerate(passage, 1):
            row.append(max(0, before[j - 1] + (2 if a == b else -1), before[j] - 1, row[-1] - 1))
        best = max(best, max(row))
    return best


def _expected(rows, toxic_ids, items):
    """Ids left after each stage, by the definitions."""
    left = [(i, t) for i, t in rows if i not in toxic_ids]
    stages = [{i for i, _ in left}]
    bare = {i: re.sub(r"[\x20\x09-\x0D]", "", t or "") for i, t in left}
    best = {}
    for i, t in left:
        best[bare[i]] = min(best.get(bare[i], (1, 0)), (-len(t or ""), i))
    left = [(i, t) for i, t in left if best[bare[i]][1] == i]
    stages.append({i for i, _ in left})
    sets = {}
    for i, t in left:
        w = (t or "").lower().split()
        sets[i] = {" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    root = {i: i for i in sets}
    for i in sets:
        for j in sets:
            if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = {k: a if r == b else r for k, r in root.items()}
    left = [(i, t) for i, t in left if root[i] == i]
    stages.append({i for i, _ in left})

    def words(t):
        return re.findall(r"[^\W_]+", (t or "").lower())

    def leaked(t):
        return any(_table_score(words(b), words(t)) >= min(len(words(b)), 40) for b in items if len(words(b)) >= 3)

    left = [(i, t) for i, t in left if not leaked(t)]
    return [*stages, {i for i, _ in left}]


def test_planted_cases_go_and_clean_documents_stay(spark, texts, prose, tmp_path):
    r = random.Random(3)
    bad = ["moron", "idiot", "scum"]
    items = [prose(7000 + i, 40) for i in range(4)]
    rows, labels, toxic = [], [], set()

    def add(i, text, label=None):
        rows.append((i, text))
        if label is not None:
            labels.append((i, 1, label))
            if label:
                toxic.add(i)

    for i in range(150):  # what the lexicon is learned from
        w = prose(i, 60).split()
        for x in r.sample(bad, 2) if i % 5 == 0 else ():
            w.insert(r.randrange(len(w)), x)
        add(i, " ".join(w), int(i % 5 == 0))
    for k, x in enumerate(["such a m0r0n here", "you 1d10t", "s c u m of it", "moron"]):  # toxic, without a label
        add(200 + k, f"{prose(300 + k, 50)} {x} {prose(310 + k, 50)}")
        toxic.add(200 + k)
    for k in range(20):  # copies but for white space
        add(400 + k, prose(1 + k % 4, 60).replace(" ", "  " if k % 3 else "\n"))
    for k in range(12):  # near copies: one or two words of 150
        w = prose(800 + k % 4, 150).split()
        w[r.randrange(150)] = f"edit{k}"
        add(500 + k, " ".join(w))
    for k, item in enumerate(items):  # whole passages, edited ones, excerpts
        edited = " ".join(x if j % 6 != 3 else f"other{k}" for j, x in enumerate(item.split()))
        add(600 + k, f"{prose(900 + k, 40)} {item} {prose(910 + k, 40)}")
        add(610 + k, f"{prose(920 + k, 40)} {edited} {prose(930 + k, 40)}")
        add(620 + k, f"{prose(940 + k, 40)} {' '.join(item.split()[5:15])} {prose(950 + k, 40)}")  # too little to count
    add(700, None), add(701, ""), add(702, "  ")
    add(703, prose(999, 5000))
    docs = texts(rows)
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    want = _expected(rows, toxic, items)
    assert [len(a) > len(b) for a, b in zip([rows, *want], want, strict=False)] == [True] * 4
    now, got = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.stored(stage(spark, now, folder), name)
        got.append({x.doc_id for x in now.collect()})
    assert got == want
    import public_tokenizers

    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    pieces = {}
    for p in corpus_pipeline.run(spark, folder).collect():
        pieces.setdefault(p.doc_id, []).append(p)
    assert pieces.keys() == want[-1]
    text = dict(rows)
    for i, of in pieces.items():
        ids = np.array(encode(text[i] or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for p in sorted(of, key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids) == of[0].doc_tokens
