"""PII by patterns, and sanitising of terms that give a protected entity away.

Patterns find e-mail and IP addresses, card and phone numbers: the protected entities. The
words of a document that holds one are terms. Over the corpus, n(e) and n(t) documents hold
the entity and the term, n(e, t) hold them together, N there are. The entity carries
-log2(n(e) / N) bits; the term reveals

    PMI(e, t) = log2(N n(e, t) / (n(e) n(t)))

of them. A term that reveals at least ``alpha`` of them, in ``min_docs`` documents or more,
is marked wherever it stands in a document with the entity (Sánchez and Batet 2016 call
this C-sanitisation). ``sanitised`` gives the spans, ``cleaned`` the texts, in which
entities and terms are generalised to their kind or removed.

Counts are aggregates and joins; a frequent entity or word is combined in the map tasks,
and joins of counts leave their side to adaptive execution. Only documents with an entity
have rows before the last step. Before terms are counted over the whole corpus, those go
that are too frequent already among documents with entities.

Defined cases: null texts are empty (and stay null in ``cleaned``), an empty table gives an
empty result, repeated rows count as documents and are marked alike, terms are lower-case
words (letters only, two or more of them), a document that holds an entity or a term twice
counts once, terms inside an entity are not marked.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import arrow_rows, fresh, only, stored, text_of, within

KINDS = ("email", "ip", "card", "phone")
ALPHA = 0.8
MIN_DOCS = 2

# Fixed patterns of the contract. Possessive repeats change no match, as what follows a
# repeat is never in its class; they keep long runs linear.
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]{2,}")
_DIGITS = re.compile(r"[^0-9]+")


def emails(text: str) -> list[tuple[int, int]]:
    """Each @ with the longest local part before it; the same matches as searching for
    the whole pattern from the left, without retrying it at every character."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at) if start < at else None
        if host:
            free = host.end()
            out.append((start, free))
        at = text.find("@", max(at + 1, free))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def entities(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all base matches in order."""
    out = [(a, 0, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.sub("", m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def spots(text: str, spans: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """All terms of a text outside of ``spans``, in lower case."""
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    out, k = [], 0
    for m in _TERM.finditer(text):
        x, y = m.span()
        while k < len(merged) and merged[k][1] <= x:
            k += 1
        if k == len(merged) or y <= merged[k][0]:
            out.append((m.group().lower(), x, y))
    return out


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: _key (of its text), doc_id, base (spans as arrays), entities (as
    digests) and, where there are some, spots (all terms with their spans)."""

    def row(key, doc_id, text):
        spans = entities(text)
        marked = [(KINDS[k], a, b) for a, k, b in spans]
        held = set()
        for a, k, b in spans:
            # The entity is only compared, so its value need not travel.
            value = text[a:b].lower() if k == 0 else _DIGITS.sub("." if k == 1 else "", text[a:b])
            held.add(hashlib.blake2b(f"{k}:{value}".encode("utf-8", "surrogatepass"), digest_size=12).hexdigest())
        return [(key, doc_id, marked, sorted(held), spots(text, [(a, b) for a, _, b in spans]) if spans else [])]

    text = text_of(f"`{text_col}`")
    slim = only(docs, *dict.fromkeys([id_col, text_col])).select(
        F.xxhash64(text).alias("_key"), F.col(f"`{id_col}`").alias("doc_id"), text.alias("text")
    )
    kind = slim.schema["doc_id"].dataType.simpleString()
    return arrow_rows(
        slim,
        row,
        f"_key bigint, doc_id {kind}, base array<struct<kind:string,start:int,end:int>>, entities array<string>,"
        " spots array<struct<term:string,start:int,end:int>>",
        flush=2_000,
    )


def revealing(docs: DataFrame, hits: DataFrame, total: int, alpha: float, min_docs: int, text_col: str) -> DataFrame:
    """(entity, term) pairs beyond the disclosure threshold, with the share revealed.

    ``hits`` has _row (a key of the row), entities and spots.
    """
    held = hits.select("_row", F.explode("entities").alias("entity"))
    often = held.groupBy("entity").agg(F.count("*").alias("ne")).filter(F.col("ne") >= min_docs)
    often = within(stored(often, "entities-often"), 160)
    terms = F.array_distinct(F.transform("spots", lambda s: s["term"])).alias("terms")
    of_row = hits.select("_row", "entities", terms)
    near = of_row.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("near"))
    pairs = of_row.select("terms", F.explode("entities").alias("entity")).join(often, "entity")
    pairs = pairs.select("entity", "ne", F.explode("terms").alias("term")).groupBy("entity", "ne", "term").agg(F.count("*").alias("net"))
    pairs = pairs.filter(F.col("net") >= min_docs)
    bits = F.log2(F.lit(float(total)) / F.col("ne"))

    def share(nt: Column) -> Column:
        pmi = F.log2(F.lit(float(total)) * F.col("net") / (F.col("ne") * nt))
        return F.when(bits > 0, pmi / bits).otherwise(F.lit(0.0))

    # A term has at least as many documents as among the hits, and reveals no more than that says.
    pairs = stored(pairs.join(near, "term").filter(share(F.col("near")) >= alpha), "pairs")
    # Broadcast while it is small, so that the words of the corpus need not shuffle.
    wanted = within(stored(pairs.select("term").distinct(), "terms"), 96)
    words = docs.select(F.array_distinct(F.split(F.lower(text_of(f"`{text_col}`")), r"[^\p{L}]+")).alias("w"))
    df = words.select(F.explode("w").alias("term")).join(wanted, "term", "left_semi").groupBy("term").agg(F.count("*").alias("nt"))
    nt = F.greatest(F.coalesce("nt", F.lit(0)), "near")
    return pairs.join(df, "term", "left").select("entity", "term", share(nt).alias("revealed")).filter(F.col("revealed") >= alpha)


def marked(
    docs: DataFrame, alpha: float = ALPHA, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: _key (of its text), doc_id, base and terms."""
    rows = stored(found(docs, id_col, text_col).withColumn("_row", F.monotonically_increasing_id()), "entities")
    total = rows.count()
    hits = rows.filter(F.size("entities") > 0)
    bad = stored(revealing(docs, hits, total, alpha, min_docs, text_col), "revealing")
    # Rows with an entity that some term gives away, with the terms that do in any of its entities.
    given = hits.select("_row", F.explode("entities").alias("entity")).join(bad.select("entity", "term"), "entity")
    spot = hits.select("_row", F.explode("spots").alias("s")).select("_row", "s.*")
    span = F.struct(F.col("start"), F.lit("term").alias("kind"), F.col("end"))
    spans = spot.join(given.select("_row", "term").distinct(), ["_row", "term"])
    spans = spans.groupBy("_row").agg(F.array_sort(F.collect_list(span)).alias("terms"))
    return rows.join(spans, "_row", "left").select(
        "_key",
        "doc_id",
        "base",
        F.transform(
            F.coalesce("terms", F.array()),
            lambda t: F.struct(t["kind"].alias("kind"), t["start"].alias("start"), t["end"].alias("end")),
        ).alias("terms"),
    )


def sanitised(docs: DataFrame, **how) -> DataFrame:
    """One row per document: doc_id, base (its entities) and terms (spans that give one
    away), both arrays of (kind, start, end) in order of start."""
    return marked(docs, **how).drop("_key")


def replaced(text: str, spans: list[tuple[int, int, str]], general: bool) -> str:
    """A text with its spans generalised to ``<kind>`` or removed; what overlaps is one span
    of the kind that starts first."""
    out, at = [], 0
    for start, end, kind in sorted(spans):
        if start >= at:
            out += [text[at:start], f"<{kind}>" if general else ""]
        at = max(at, end)
    return "".join([*out, text[at:]])


def cleaned(docs: DataFrame, general: bool = True, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with entities and revealing terms generalised to their kind, or removed.

    Only texts with something to replace are joined, by a key of their text: rows with the
    same text and the same id are marked alike, and so are rows of one text, by all its marks.
    """
    spans = marked(docs, id_col=id_col, text_col=text_col, **how)
    of, marks = fresh(docs, "_marked"), fresh(docs, "_spans")
    spans = spans.select(F.col("_key").alias(of), F.concat("base", "terms").alias(marks)).filter(F.size(marks) > 0)
    spans = stored(spans.dropDuplicates([of]), "marks")

    @F.pandas_udf("string")
    def rewritten(texts: pd.Series, found: pd.Series) -> pd.Series:
        def one(text, spans):
            return text if spans is None or text is None else replaced(text, [(s["start"], s["end"], s["kind"]) for s in spans], general)

        return pd.Series([one(t, s) for t, s in zip(texts, found, strict=True)], dtype=object)

    key = F.xxhash64(text_of(f"`{text_col}`"))
    joined = docs.join(within(spans, 512), key == F.col(of), "left")
    names = [rewritten(F.col(f"`{c}`"), F.col(marks)).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*names)
