"""Queries of the operators that count, learn or audit over whole tables: 11, 12, 13."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import collocations, filter_audit, quality
from tickloom.llm.common import table
from tickloom.llm.native import query

#: A document scored this high is predicted to be good.
KEPT = 0.5


@query(
    """
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents
    ), listed AS (
        SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces
    ), places AS (
        SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM listed WHERE len(w) > 0
    ), totals AS (
        SELECT lang, count(*) AS n FROM places GROUP BY lang
    ), counted AS (
        SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
        FROM places, range(1, 6) s(size) WHERE i + size - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100
    ), candidates AS (
        SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE size > 1
    ), covered AS (
        SELECT DISTINCT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, a AS over
        FROM candidates, range(2, 5) s(k), range(1, 5) t(i) WHERE k < size AND i + k - 1 <= size
    ), lefts AS (
        SELECT * FROM candidates c
        WHERE NOT EXISTS (FROM covered o WHERE o.lang = c.lang AND o.phrase = c.phrase AND 100 * o.over >= 100 * c.a)
    ), cuts AS (
        SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, t.n, k,
            ((1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
        FROM lefts c, range(1, 5) s(k), totals t, counted x, counted y
        WHERE k < c.size AND t.lang = c.lang
            AND x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
            AND y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
    ), lowest AS (
        SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM lowest
    )
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
    """
)
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2,000 strongest phrases."""
    return collocations.top(table(spark, sf_dir, "documents"))


@query()
def op12_rule_ensemble_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality score."""
    scored = quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= KEPT).cast("int").alias("predicted"),
    )


@query(
    """
    WITH texts AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
    ), firsts AS (
        SELECT *, min(doc_id) OVER (PARTITION BY text) AS first,
            list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
        FROM texts
    ), known AS (
        SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id
    ), judged AS (
        SELECT f.part, coalesce(k.quality = 1, false) AS good, coalesce(k.toxic = 1, false) AS toxic,
            MAP {
                'A': len(w) < 200,
                'B': 100 * list_unique(w) < 50 * len(w),
                'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
                'D': regexp_matches(text, '[#$%&*|]'),
                'E': coalesce(f.doc_id > first, false)
            } AS fails
        FROM firsts f LEFT JOIN known k USING (doc_id)
    ), counted AS (
        SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
        FROM judged GROUP BY ALL
    ), letters AS (
        SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
    ), orders AS (
        SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
        FROM letters a, letters b, letters c, letters d, letters e
        WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
    ), steps AS (
        SELECT filter_order, step::INTEGER AS step, filter_order[step] AS letter,
            string_split(filter_order[1:step - 1], '') AS before
        FROM orders, range(1, 6) s(step)
    ), walked AS (
        SELECT part, filter_order, step, letter, n, good, toxic, fails[letter] AS hit,
            len(list_filter(before, lambda x: x <> '' AND fails[x])) > 0 AS gone,
            len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: fails[x])) = 1 AS single
        FROM counted, steps
    ), summed AS (
        SELECT part, filter_order, step, letter,
            coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0)::BIGINT AS kept,
            coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed,
            coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant,
            coalesce(sum(n) FILTER (hit AND single), 0)::BIGINT AS unique_fails,
            coalesce(sum(good) FILTER (hit AND NOT gone), 0)::BIGINT AS good_lost,
            coalesce(sum(toxic) FILTER (hit AND NOT gone), 0)::BIGINT AS toxic_lost
        FROM walked GROUP BY ALL
    )
    SELECT * EXCLUDE (letter), (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM summed
    """
)
def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each filter removes at each step of each order of five filters."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
