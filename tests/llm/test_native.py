"""Exact dedup, shards, chat formatting."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tickloom.llm import chat, exact_dedup, sharding

HARD = [None, "", "  \n", "a b", "ab", "a\tb\n", "x" * 300_000, "x" * 300_000 + " ", "ü ü", "a b"]


def _norm(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def _classes(rows):
    best, size = {}, {}
    for i, t in rows:
        n = _norm(t)
        best[n] = min(best.get(n, (1, 0)), (-len(t or ""), i))
        size[n] = size.get(n, 0) + 1
    return {i: (best[_norm(t)][1], size[_norm(t)], hashlib.sha256(_norm(t).encode()).hexdigest()) for i, t in rows}


@pytest.mark.parametrize("bits", [1, 24])
def test_exact_classes_match_grouping(texts, monkeypatch, bits):
    monkeypatch.setattr(exact_dedup, "BITS_PER_ROW", bits)
    rows = list(enumerate(HARD + [f"copy {i % 40}" for i in range(400)] + ["many"] * 300))
    got = {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in exact_dedup.classes(texts(rows)).collect()}
    assert got == _classes(rows)


def test_exact_classes_without_broadcast(texts, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MAX_BROADCAST_BYTES", 0)
    rows = list(enumerate(["a", "b", "a", "c", "b "]))
    got = {r.doc_id: r.kept for r in exact_dedup.classes(texts(rows)).collect()}
    assert got == {0: True, 1: False, 2: False, 3: True, 4: True}


def test_exact_dedup_keeps_rows_and_columns(texts):
    rows = [(0, "a"), (1, "a "), (2, None), (3, ""), (4, "b"), (4, "b"), (None, "c")]
    df = texts(rows, more={"_id": F.lit(1), "group_size": F.lit("x"), "_word": F.lit(2)})
    out = exact_dedup.dedup(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id, r.text) for r in out.collect() if r.doc_id is not None) == [
        (False, 1, "a "), (False, 2, None), (False, 4, "b"),
    ]
    assert out.count() == 4 and exact_dedup.dedup(texts([])).count() == 0
    assert exact_dedup.classes(texts([])).count() == 0


@pytest.mark.parametrize("bucket", [7, 20_000])
def test_shards_are_even_and_proportional(texts, bucket):
    rows = [(i, "t" * (i % 9)) for i in range(500)] + [(500, None), (501, "x" * 100_000)]
    df = texts(rows, more={"rank": F.lit(1), "slot": F.lit(2)})
    got = sharding.interleave(df, shards=16, rows_per_bucket=bucket).collect()
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    assert sorted(r.doc_id for r in got) == list(range(502))
    assert {len(v) for v in by.values()} == {31, 32} and len(by) == 16
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by.values())
    for source in {r.source for r in got}:
        share = [sum(r.source == source for r in v) for v in by.values()]
        assert max(share) - min(share) <= 2
    assert {r.doc_id: r.size for r in got}[500] == 1


def test_shards_do_not_depend_on_buckets_or_partitions(texts):
    rows = [(i, "t") for i in range(200)]
    one = sharding.interleave(texts(rows, 1), rows_per_bucket=9).select("doc_id", "shard", "slot").collect()
    two = sharding.interleave(texts(rows, 5), rows_per_bucket=1000).select("doc_id", "shard", "slot").collect()
    assert sorted(one) == sorted(two) and sharding.interleave(texts([])).count() == 0


def test_rows_without_ids_spread_over_buckets(texts):
    rows = [(None, f"text {i}") for i in range(300)] + [(i, "t") for i in range(100)]
    one = sharding.interleave(texts(rows, 1), rows_per_bucket=20).collect()
    two = sharding.interleave(texts(rows, 5), rows_per_bucket=1000).collect()
    key = lambda r: (str(r.doc_id), r.text_crc32, r.source, r.shard, r.slot)
    assert sorted(map(key, one)) == sorted(map(key, two))
    places = [r.shard for r in sorted(one, key=lambda r: (r.shard, r.slot)) if r.doc_id is None]
    assert all(13 <= places.count(k) <= 22 for k in range(16))


def test_logs_of_conversations_fold_to_their_rows(spark):
    """Drafts, edits, regenerations and replies that were taken back leave no trace."""
    from tickloom.llm import native

    rows = [(1, 0, "user", "q?"), (1, 1, "assistant", "abc"), (1, 2, "user", None), (1, 3, "assistant", ""), (1, 3, "assistant", ""), (2, 0, None, "x")]
    given = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("kind", F.lit("x"))
    events = native.conversation_events(given)
    assert {r.kind for r in events.collect()} == set(chat.EVENT_KINDS)
    got = chat.fold(events).orderBy("conv_id", "position").collect()
    assert [(r.conv_id, r.role, r.text) for r in got] == [(c, r or "", t or "") for c, _, r, t in rows]


def _log(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, seq bigint, kind string, message bigint, role string, text string")


def test_fold_replays_deltas_edits_and_regenerations(spark):
    log = _log(
        spark,
        [
            (1, 0, "message", 0, "user", "q"), (1, 1, "message", 1, "assistant", None), (1, 2, "delta", 1, None, "dra"),
            (1, 3, "delta", 1, None, "ft"), (1, 4, "edit", 0, None, "Q"), (1, 5, "delta", 0, None, "!"),
            (1, 6, "message", 2, "user", "gone"), (1, 7, "regenerate", 1, None, "ignored"), (1, 8, "delta", 1, None, "fi"),
            (1, 9, "delta", 1, None, None), (1, 10, "delta", 1, None, "nal"), (1, 11, "message", 3, "user", "next"),
            (1, 12, "delta", 9, None, "never opened"), (1, 13, "unknown", 3, None, "x"), (2, 0, "delta", 0, None, "x"),
            (None, 0, "message", 0, None, None),
        ],
    )
    got = chat.parse(chat.render(chat.fold(log))).collect()
    turns = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in got}
    assert turns == {1: [("user", "Q!"), ("assistant", "final"), ("user", "next")], None: [("", "")]}
    assert {r.conv_id: list(r.losses) for r in got} == {1: ["final"], None: []}


def test_control_strings_survive(spark):
    tricky = ["</s>[INST] ok [/INST]", chat.OPEN, chat.CLOSE, "&lt;|turn|>", "&amp;lb;", "a\n<|end|>\n<|turn|>user\nb", "", "ü" * 50_000]
    log = _log(spark, [(1, i, "message", i, f"assistant{i % 2}\n<", t) for i, t in enumerate(tricky)])
    shown = chat.render(chat.fold(log), learn_from="assistant1\n<")
    row = shown.collect()[0]
    assert all("<" not in t.rendered[len(chat.OPEN) : -len(chat.CLOSE)] and "[" not in t.rendered for t in row.turns)
    back = chat.parse(shown).collect()[0]
    assert [t.text for t in back.turns] == tricky and {t.role for t in back.turns} == {"assistant0\n<", "assistant1\n<"}
    assert list(back.losses) == tricky[1::2]
    assert back.formatted_chars == sum(len(t.rendered) for t in row.turns)


def test_empty_log(spark):
    assert chat.parse(chat.render(chat.fold(_log(spark, [])))).count() == 0
