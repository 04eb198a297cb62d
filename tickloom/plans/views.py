"""The adapters' views as DuckDB common table expressions."""

from __future__ import annotations

_VIEWS = {
    "ticks": """ticks AS (
  SELECT CASE lower(event_type) WHEN 'view' THEN 'VIEW' WHEN 'click' THEN 'CLICK' WHEN 'error' THEN 'ERROR'
           WHEN 'signup' THEN 'SIGNU' WHEN 'purchase' THEN 'PURCH' END AS ticker,
         50.0::DOUBLE + 0.25::DOUBLE * json_extract_string(props, '$.k')::BIGINT AS price,
         floor(value)::BIGINT AS size,
         1704067200000000 + (epoch_us(ts) - 1704067200000000) // 100 AS ts_us,
         event_id AS seq,
         json_extract_string(props, '$.k')::BIGINT AS k,
         value
  FROM events)""",
    "quotes": """quotes AS (
  SELECT ticker,
         CASE WHEN seq % 35 = 0 THEN 0.0::DOUBLE ELSE price - 0.01::DOUBLE * (seq % 5) END AS bid_price,
         price + 0.01::DOUBLE * (seq % 3) AS ask_price,
         k AS bid_size, 99 - k AS ask_size, ts_us, seq
  FROM ticks WHERE seq % 7 = 0)""",
    "news": """news AS (
  SELECT doc_id AS id,
         ['VIEW','CLICK','ERROR','SIGNU','PURCH'][doc_id % 5 + 1] AS ticker,
         substring(text, 1, 120) AS headline, substring(text, 121) AS summary, source,
         1704067200000000 + (doc_id * 7919 % 25920) * 1000000 AS ts_us
  FROM documents)""",
    "texts": """texts AS (
  SELECT *, concat_ws(' ', nullif(trim(headline, ' '), ''), nullif(trim(summary, ' '), '')) AS text
  FROM news)""",
    "scored": """toks0 AS (
  SELECT id, list_filter(list_transform(regexp_split_to_array(replace(text, '\u2019', ''''), '[^\\p{L}'']+'), lambda x: trim(x, '''')), lambda x: x <> '') AS ts,
         least(length(text) - length(replace(text, '!', '')), 4) * 292000::BIGINT
           + CASE WHEN q > 3 THEN 960000 WHEN q > 1 THEN q * 180000 ELSE 0 END AS e
  FROM (SELECT *, length(text) - length(replace(text, '?', '')) AS q FROM texts) WHERE text <> ''),
toks AS (SELECT id, lower(w) AS token, w = upper(w) AND w <> lower(w) AS caps, pos
  FROM (SELECT id, unnest(ts) AS w, generate_subscripts(ts, 1) AS pos FROM toks0)),
shape AS (
  SELECT id, count(*) FILTER (caps) BETWEEN 1 AND count(*) - 1 AS mixed, min(pos) FILTER (token = 'but') AS turn FROM toks GROUP BY id),
ctx AS (
  SELECT id, token, pos, caps AND mixed AS loud, turn,
         lag(token, 1) OVER w AS p1, lag(token, 2) OVER w AS p2, lag(token, 3) OVER w AS p3,
         lag(caps AND mixed, 1) OVER w AS c1, lag(caps AND mixed, 2) OVER w AS c2, lag(caps AND mixed, 3) OVER w AS c3
  FROM toks JOIN shape USING (id) WINDOW w AS (PARTITION BY id ORDER BY pos)),
hits AS (
  SELECT id, CASE WHEN v IS NULL THEN NULL ELSE
           (v * 1000 + sign(v)::BIGINT * (CASE WHEN loud THEN 733000 ELSE 0 END
              + CASE p1 WHEN 'by' THEN 293000 WHEN 'for' THEN -293000 ELSE 0 END + CASE WHEN c1 AND p1 IN ('by', 'for') THEN 733000 ELSE 0 END
              + CASE p2 WHEN 'by' THEN 278350 WHEN 'for' THEN -278350 ELSE 0 END + CASE WHEN c2 AND p2 IN ('by', 'for') THEN 696350 ELSE 0 END
              + CASE p3 WHEN 'by' THEN 263700 WHEN 'for' THEN -263700 ELSE 0 END + CASE WHEN c3 AND p3 IN ('by', 'for') THEN 659700 ELSE 0 END))
           * CASE WHEN regexp_matches(concat_ws(' ', p1, p2, p3), '(^| )(is|[^ ]*n''t)( |$)') THEN -740 ELSE 1000 END // 1000
           * CASE WHEN pos < turn THEN 1 WHEN pos > turn THEN 3 ELSE 2 END END AS m
  FROM (SELECT *, CASE token WHEN 'that' THEN 1500::BIGINT WHEN 'was' THEN -1200 WHEN 'with' THEN 800
                             WHEN 'from' THEN -900 END AS v FROM ctx)),
plain AS (
  SELECT id, count(*) AS n_tokens, count(m) AS n_hits, coalesce(sum(m), 0)::BIGINT AS raw,
         coalesce(sum(m + 2000000) FILTER (m > 0), 0)::BIGINT AS p0,
         coalesce(sum(2000000 - m) FILTER (m < 0), 0)::BIGINT AS n0,
         ((count(*) FILTER (m IS NULL OR m = 0)) * 2000000)::DOUBLE AS us
  FROM hits GROUP BY id),
sums AS (
  SELECT id, n_tokens, n_hits, raw + sign(raw)::BIGINT * 2 * e AS raw_score, us,
         (p0 + CASE WHEN p0 > n0 THEN 2 * e ELSE 0 END)::DOUBLE AS ps, (n0 + CASE WHEN n0 > p0 THEN 2 * e ELSE 0 END)::DOUBLE AS ns
  FROM plain JOIN toks0 USING (id)),
scored AS (
  SELECT t.id, t.ticker, t.ts_us, t.source, t.headline, coalesce(n_tokens, 0) AS n_tokens, coalesce(n_hits, 0) AS n_hits,
         coalesce(raw_score, 0) AS raw_score,
         coalesce(raw_score::DOUBLE / sqrt(raw_score::DOUBLE * raw_score::DOUBLE + 15.0::DOUBLE * 4e12), 0) AS compound,
         coalesce(ps / (ps + ns + us), 0) AS positive, coalesce(us / (ps + ns + us), 0) AS neutral,
         coalesce(ns / (ps + ns + us), 0) AS negative
  FROM texts t LEFT JOIN sums USING (id) WHERE t.text <> '')""",
    "zprior": """zprior AS (
  SELECT *, CASE WHEN n = 0 THEN 0.0 WHEN mn = mx THEN sign(size - mn)::DOUBLE
            ELSE ((n * x - s) / n) / sqrt(spread / (n * (n - 1.0))) END AS volume_zscore
  FROM (SELECT *, size::DOUBLE AS x, (count(size) OVER w)::DOUBLE AS n, (sum(size) OVER w)::DOUBLE AS s,
               ((count(size) OVER w) * (sum(size::HUGEINT * size) OVER w) - (sum(size) OVER w) * (sum(size) OVER w))::DOUBLE AS spread,
               min(size) OVER w AS mn, max(size) OVER w AS mx
        FROM ticks
        WINDOW w AS (PARTITION BY ticker ORDER BY ts_us, seq ROWS BETWEEN 19 PRECEDING AND 1 PRECEDING)))""",
    "enriched": """enriched AS (
  SELECT z.*,
         CASE WHEN sum(size) OVER w1 > 0 THEN (sum(price * size) OVER w1) / (sum(size) OVER w1)::DOUBLE ELSE 0.0 END AS vwap_1min,
         CASE WHEN sum(size) OVER w5 > 0 THEN (sum(price * size) OVER w5) / (sum(size) OVER w5)::DOUBLE ELSE 0.0 END AS vwap_5min,
         (sum(price) OVER w5) / (count(*) OVER w5) AS avg_price_5min,
         count(*) OVER w1 AS trade_count_60s,
         CASE WHEN lag(price) OVER wl > 0 THEN (price - lag(price) OVER wl) / (lag(price) OVER wl) * 100.0 ELSE 0.0 END AS momentum
  FROM zprior z
  WINDOW w1 AS (PARTITION BY ticker ORDER BY ts_us RANGE BETWEEN 60000000 PRECEDING AND CURRENT ROW),
         w5 AS (PARTITION BY ticker ORDER BY ts_us RANGE BETWEEN 300000000 PRECEDING AND CURRENT ROW),
         wl AS (PARTITION BY ticker ORDER BY ts_us, seq))""",
    "tradewin": """tradewin AS (
  SELECT ticker, ts_us - ts_us % 60000000 AS window_start_us, max(volume_zscore) AS max_zscore,
         arg_max(vwap_1min, ts_us) AS vwap_1min, arg_max(vwap_5min, ts_us) AS vwap_5min,
         arg_max(momentum, ts_us) AS momentum, count(*) AS trade_count
  FROM enriched GROUP BY ALL)""",
    "newswin": """newswin AS (
  SELECT ticker, ts_us - ts_us % 60000000 AS window_start_us, max(abs(compound)) AS max_abs_compound,
         arg_max(compound, (abs(compound), ts_us, id)) AS best_compound, count(*) AS news_count,
         bool_or(abs(compound) > 0.5) AS had_strong_sentiment
  FROM scored GROUP BY ALL)""",
    "linked": """linked AS (
  SELECT s.*, CASE WHEN s.ts_us - z.ts_us <= 60000000 THEN z.volume_zscore END AS volume_zscore
  FROM scored s ASOF LEFT JOIN zprior z ON s.ticker = z.ticker AND s.ts_us >= z.ts_us)""",
    "signals": """signals AS (
  SELECT *, CASE WHEN compound >= 0.05 THEN 'positive' WHEN compound <= -0.05 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
         coalesce(volume_zscore >= 2.0, false) AS correlated,
         CASE WHEN volume_zscore IS NULL OR volume_zscore < 2.0 THEN 'none'
              WHEN abs(compound) >= 0.5 AND volume_zscore >= 3.0 THEN 'strong'
              WHEN abs(compound) >= 0.2 THEN 'moderate' ELSE 'weak' END AS correlation_strength
  FROM linked)""",
    "requests": """requests AS (
  SELECT ts_us, seq, value * 2 AS latency_ms,
         CASE WHEN seq % 11 = 0 THEN '/market-prices' WHEN seq % 13 = 0 THEN '/static/app.js'
              ELSE ['/quotes/','/aggregations/','/anomalies/','/features/','/sentiment/','/quote/'][seq % 6 + 1] || lower(ticker) END AS path,
         CASE WHEN seq % 97 = 0 THEN 500 WHEN seq % 41 = 0 THEN 404 ELSE 200 END::BIGINT AS status
  FROM ticks)""",
    "bars": """days AS (
  SELECT o_orderpriority AS idx, o_orderdate::DATE AS d, arg_min(o_totalprice, o_orderkey) AS open,
         max(o_totalprice) AS high, min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
         count(*) AS orders
  FROM orders GROUP BY o_orderpriority, o_orderdate::DATE),
bars AS (
  SELECT idx AS "index", strftime(d, '%d/%m/%y') AS date, d, open, high, low, close, close AS adj_close,
         CASE WHEN day(d) % 10 = 0 THEN 0 ELSE orders END AS volume, close * 0.5 AS close_usd
  FROM days)""",
}

_NEEDS = {
    "quotes": ["ticks"],
    "texts": ["news"],
    "scored": ["texts"],
    "zprior": ["ticks"],
    "enriched": ["zprior"],
    "tradewin": ["enriched"],
    "newswin": ["scored"],
    "linked": ["scored", "zprior"],
    "signals": ["linked"],
    "requests": ["ticks"],
}


def sql(names: str, body: str) -> str:
    """``body`` with the named views (and what they need) in front of it."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _NEEDS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names.split():
        visit(n)
    ctes = ",\n".join(_VIEWS[n] for n in order)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
