"""Isolation forests as DuckDB common table expressions, grown level by level.

The draws are those of ``functions.iforest``; its constants come from there.
"""

from __future__ import annotations

from tickloom.functions import iforest
from tickloom.operators.anomaly import Forest
from tickloom.plans.views import sql

P = iforest.PRIME

#: The features of the live path from the view of enriched ticks.
LIVE = """featured AS (
  SELECT ticker, ts_us, seq, price, size::DOUBLE AS volume, vwap_1min, volume_zscore, momentum,
         0.0::DOUBLE AS bid_ask_spread, trade_count_60s::DOUBLE AS trade_frequency FROM enriched)"""


def _mixed(state: str, x: str) -> str:
    t = f"(({state} + ({x}) * 16807) % {P})"
    return f"(({t} * {t} % {P}) * 48271 + 1) % {P}"


def _drawn(first: str) -> str:
    """The second step of a draw, of the column that holds the first."""
    return _mixed(first, "0::BIGINT")


def forest_sql(forest: Forest = Forest(), featured: str = LIVE) -> str:
    """The expressions ``nodes``, ``offsets`` and ``verdicts`` over ``featured``."""
    f, i = list(forest.features), forest.interval
    k = len(f)
    deepest = iforest.depth_of(forest.sample)
    x = ", ".join(f'"{c}"' for c in f)
    parts = [
        featured,
        f"""numbered AS MATERIALIZED (
  SELECT ticker, ts_us, seq, [{x}] AS x, row_number() OVER (PARTITION BY ticker ORDER BY ts_us, seq) AS o FROM featured)""",
        f"""counts AS (SELECT ticker, max(o) AS total FROM numbered GROUP BY ticker)""",
        f"""named AS (
  SELECT ticker, total, ('0x' || substr(md5(ticker), 1, 8))::BIGINT % {P} AS name FROM counts)""",
        f"""named2 AS (SELECT *, {_mixed("name", f"{forest.seed}::BIGINT")} AS seeded FROM named)""",
        f"""forests AS MATERIALIZED (
  SELECT ticker, v, {_mixed("seeded", "v")} AS h, greatest(v * {i} - {forest.window}, 0) AS skip,
         least(v * {i}, {forest.window}) AS n, least(v * {i}, {forest.window}, {forest.sample}) AS psi
  FROM (SELECT *, unnest(range(1, total // {i} + 1)) AS v FROM named2) WHERE v * {i} >= {forest.warmup})""",
        f"""trees AS MATERIALIZED (
  SELECT ticker, v, tree, n, psi, skip, {_mixed("h", "tree")} AS h, greatest(1, ceil(log2(greatest(psi, 2))))::BIGINT AS depth
  FROM forests, range(0, {forest.trees}) r(tree))""",
        f"""slices AS (
  SELECT *, k * n // psi AS low, (k + 1) * n // psi AS high, {_mixed("h", "k")} AS d0 FROM trees, range(0, {forest.sample}) r(k) WHERE k < psi)""",
        f"""picked AS (SELECT ticker, v, tree, h, depth, skip + low + ({_drawn("d0")}) % (high - low) + 1 AS o FROM slices)""",
        """at0 AS MATERIALIZED (
  SELECT p.ticker, p.v, p.tree, p.h, p.depth, 0::BIGINT AS node, x FROM picked p JOIN numbered USING (ticker, o))""",
    ]
    for level in range(deepest + 1):
        lows = ", ".join(f"min(x[{j + 1}]) AS a{j}, max(x[{j + 1}]) AS b{j}" for j in range(k))
        firsts = ", ".join(f"{_mixed('hn', f'{j}::BIGINT')} AS e{j}" for j in range(k + 1))
        picks = ", ".join(f"CASE WHEN a{j} < b{j} THEN {_drawn(f'e{j + 1}')} ELSE -1 END" for j in range(k))
        low = " ".join(f"WHEN {j} THEN a{j}" for j in range(k))
        high = " ".join(f"WHEN {j} THEN b{j}" for j in range(k))
        parts += [
            f"""seen{level} AS (
  SELECT ticker, v, tree, node, any_value(depth) AS depth, count(*) AS c, {_mixed("any_value(h)", f"{iforest.NODES} + node")} AS hn, {lows}
  FROM at{level} GROUP BY ticker, v, tree, node)""",
            f"""first{level} AS (SELECT *, {firsts} FROM seen{level})""",
            f"""pick{level} AS (SELECT *, [{picks}] AS picks, {_drawn("e0")} AS d FROM first{level})""",
            f"""best{level} AS (
  SELECT *, list_position(picks, list_max(picks)) - 1 AS f, list_max(picks) >= 0 AND c > 1 AND {level} < depth AS cuts FROM pick{level})""",
            f"""edge{level} AS (SELECT *, CASE f {low} END AS least, CASE f {high} END AS most FROM best{level})""",
            f"""made{level} AS MATERIALIZED (
  SELECT ticker, v, tree, node, CASE WHEN cuts THEN f ELSE -1 END AS feature,
         CASE WHEN NOT cuts THEN 0.0 WHEN least + d / {float(P)}::DOUBLE * (most - least) < most THEN least + d / {float(P)}::DOUBLE * (most - least) ELSE least END AS threshold,
         CASE WHEN cuts THEN 0 ELSE {level * iforest.BILLION} + floor(CASE WHEN c > 2 THEN 2.0 * (ln(c - 1.0::DOUBLE) + {iforest.EULER}::DOUBLE) - 2.0 * (c - 1.0::DOUBLE) / c::DOUBLE WHEN c = 2 THEN 1.0 ELSE 0.0 END * 1e9::DOUBLE + 0.5)::BIGINT END AS value
  FROM edge{level})""",
        ]
        if level < deepest:
            parts.append(
                f"""at{level + 1} AS MATERIALIZED (
  SELECT r.ticker, r.v, r.tree, r.h, r.depth, 2 * r.node + 1 + CASE WHEN r.x[m.feature + 1] > m.threshold THEN 1 ELSE 0 END AS node, r.x
  FROM at{level} r JOIN made{level} m USING (ticker, v, tree, node) WHERE m.feature >= 0)"""
            )
    made = " UNION ALL ".join(f"SELECT * FROM made{level}" for level in range(deepest + 1))
    parts += [
        f"nodes AS MATERIALIZED ({made})",
        # Rows a version trains on, and rows it scores.
        f"""asked AS (
  SELECT t.ticker, t.v, t.psi, o, x, o <= t.skip + t.n AS trains FROM forests t JOIN numbered n ON n.ticker = t.ticker
    AND n.o > t.skip AND n.o <= (t.v + 1) * {i})""",
        f"""walk0 AS (SELECT ticker, v, psi, o, x, tree, 0::BIGINT AS node, 0::BIGINT AS path FROM asked, range(0, {forest.trees}) r(tree))""",
    ]
    for level in range(deepest + 1):
        parts.append(
            f"""walk{level + 1} AS (
  SELECT w.ticker, w.v, w.psi, w.o, w.x, w.tree,
         CASE WHEN m.feature >= 0 THEN 2 * w.node + 1 + CASE WHEN w.x[m.feature + 1] > m.threshold THEN 1 ELSE 0 END ELSE -1 END AS node,
         w.path + coalesce(m.value, 0) AS path
  FROM walk{level} w LEFT JOIN nodes m ON m.ticker = w.ticker AND m.v = w.v AND m.tree = w.tree AND m.node = w.node)"""
        )
    usual = f"greatest(floor(CASE WHEN psi > 2 THEN 2.0 * (ln(psi - 1.0::DOUBLE) + {iforest.EULER}::DOUBLE) - 2.0 * (psi - 1.0::DOUBLE) / psi::DOUBLE WHEN psi = 2 THEN 1.0 ELSE 0.0 END * 1e9::DOUBLE + 0.5)::BIGINT, 1)"
    share = round(forest.contamination * 1000)
    parts += [
        f"""raws AS MATERIALIZED (
  SELECT ticker, v, o, floor(-pow(2.0::DOUBLE, -(sum(path)::DOUBLE / ({forest.trees} * {usual})::DOUBLE)) * 1e9::DOUBLE + 0.5)::BIGINT AS raw
  FROM walk{deepest + 1} GROUP BY ticker, v, psi, o)""",
        f"""ranked AS (
  SELECT ticker, v, raw, row_number() OVER (PARTITION BY ticker, v ORDER BY raw) - 1 AS r, count(*) OVER (PARTITION BY ticker, v) AS n
  FROM raws JOIN forests USING (ticker, v) WHERE o <= forests.skip + forests.n)""",
        f"""offsets AS (
  SELECT ticker, v, sum(CASE WHEN r = (n - 1) * {share} // 1000 THEN raw * (1000 - (n - 1) * {share} % 1000)
      WHEN r = (n - 1) * {share} // 1000 + 1 THEN raw * ((n - 1) * {share} % 1000) ELSE 0 END)::BIGINT AS cut
  FROM ranked GROUP BY ticker, v)""",
        f"""verdicts AS (
  SELECT n.ticker, n.ts_us, n.seq, n.x, n.o AS ordinal, (n.o - 1) // {i} AS version,
         CASE WHEN c.cut IS NULL THEN 0.0 ELSE r.raw / 1e9::DOUBLE END AS raw_score,
         CASE WHEN c.cut IS NULL THEN 0.0 ELSE (r.raw * 1000 - c.cut) / 1e12::DOUBLE END AS score,
         coalesce(r.raw * 1000 < c.cut, false) AS is_anomaly, c.cut IS NULL AS warming_up
  FROM numbered n LEFT JOIN raws r ON r.ticker = n.ticker AND r.o = n.o AND r.v = (n.o - 1) // {i}
    LEFT JOIN offsets c ON c.ticker = n.ticker AND c.v = (n.o - 1) // {i})""",
    ]
    return ",\n".join(parts)


def trees_sql(forest: Forest = Forest(), featured: str = LIVE, views: str = "enriched") -> str:
    """Every node of every forest."""
    return sql(
        views,
        f"""WITH {forest_sql(forest, featured)}
SELECT ticker, v AS version, tree::INTEGER AS tree, node::INTEGER AS node, feature::INTEGER AS feature, threshold, value FROM nodes
WHERE feature >= 0 OR value > 0""",
    )


def scored_sql(forest: Forest = Forest(), featured: str = LIVE, views: str = "enriched", body: str | None = None) -> str:
    """Every row with its verdict, or ``body`` over ``verdicts``."""
    body = body or "SELECT ticker, ts_us, seq, ordinal, version, raw_score, score, is_anomaly, warming_up FROM verdicts"
    return sql(views, f"WITH {forest_sql(forest, featured)}\n{body}")


