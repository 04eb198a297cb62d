"""Anomaly flags from per-ticker isolation forests that are refitted as events arrive.

Version v of a ticker's forest is fitted on the last ``window`` events up to event
v * ``interval`` and scores the ``interval`` events after it. Both are row counts, so
every piece of work has a fixed size however busy the ticker is: events are cut into
blocks of ``block`` versions, each with the events it trains on, and one task per block
fits and scores them. No model is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, GroupedData, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions import iforest
from tickloom.functions.exact import notional, ratio
from tickloom.operators import rolling
from tickloom.operators.ordered import last_known, over_time

FEATURES_7D = [
    "price",
    "volume",
    "vwap_1min",
    "volume_zscore",
    "momentum",
    "bid_ask_spread",
    "trade_frequency",
]
FEATURES_6D = ["price", "volume", "volume_zscore", "price_momentum", "vwap_deviation", "trade_frequency"]
ID = ["ticker", "ts_us", "seq"]


@dataclass(frozen=True)
class Forest:
    """How forests are fitted. The defaults are those of the live path."""

    features: tuple[str, ...] = tuple(FEATURES_7D)
    trees: int = 100
    sample: int = 256
    contamination: float = 0.05
    window: int = 5000
    interval: int = 1000
    warmup: int = 500
    seed: int = 42
    block: int = 10


def features_7d(ticks: DataFrame, **opts) -> DataFrame:
    """Feature vector of each tick; ``spread`` is used if there is such a column."""
    spread = F.col("spread") if "spread" in ticks.columns else F.lit(0.0)
    return rolling.enrich(ticks, **opts).select(
        *ID,
        "price",
        F.col("size").cast("double").alias("volume"),
        "vwap_1min",
        "volume_zscore",
        "momentum",
        spread.alias("bid_ask_spread"),
        F.col("trade_count_60s").cast("double").alias("trade_frequency"),
    )


def features_6d(ticks: DataFrame, **opts) -> DataFrame:
    """The scaled variant's vector: inclusive z-score, gap-limited momentum, VWAP deviation."""
    n = rolling.ZSCORE_ROWS

    def momentum(w: WindowSpec) -> Column:
        near = F.col("ts_us") - F.lag("ts_us").over(w) < 60_000_000
        change = rolling.percent_change(F.col("price"), F.lag("price").over(w))
        return F.when(near, change).otherwise(F.lit(0.0))

    t = over_time(
        ticks,
        spans_s=[60, 300],
        measures={"_pv": notional(), "_v": F.col("size"), "_n": F.lit(1).cast("bigint")},
        history=n - 1,
        history_cols=["size", "price"],
        row_exprs={"volume_zscore": lambda w: rolling._inclusive_z(w, n), "price_momentum": momentum},
        **opts,
    )
    vwap = ratio(F.col("_pv_300"), F.col("_v_300"))
    return t.select(
        *ID,
        "price",
        F.col("size").cast("double").alias("volume"),
        "volume_zscore",
        "price_momentum",
        F.when(vwap != 0, F.col("price") - vwap).otherwise(F.lit(0.0)).alias("vwap_deviation"),
        F.col("_n_60").cast("double").alias("trade_frequency"),
    )


def as_map(df: DataFrame, names: list[str], out: str = "features") -> DataFrame:
    """Feature columns as one map, as stored with an anomaly."""
    m = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*names))
    return df.select(*[c for c in df.columns if c not in names], m.alias(out))


def epochs(df: DataFrame, forest: Forest = Forest(), **opts) -> DataFrame:
    """Add ordinal, epoch (the forest version that scores the row) and warming_up."""
    n = F.col("ordinal")
    return rolling.ordinals(df, **opts).select(
        "*",
        F.floor((n - 1) / forest.interval).cast("bigint").alias("epoch"),
        (n < forest.warmup).alias("warming_up"),
    )


def training_counts(df: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """Size of each version's training set. Needs ordinal."""
    n, i = F.col("ordinal"), forest.interval
    first = F.ceil(n / i).cast("bigint")
    last = F.floor((n + forest.window - 1) / i).cast("bigint")
    due = F.col("version") * i
    return (
        df.select("ticker", "ordinal", F.explode(F.sequence(first, last)).alias("version"))
        .groupBy("ticker", "version")
        .agg(F.count("*").alias("n"), F.max("ordinal").alias("_last"))
        .filter((F.col("_last") == due) & (due >= forest.warmup))
        .drop("_last")
    )


def _blocks(df: DataFrame, forest: Forest) -> GroupedData:
    """Rows copied to the blocks that train on or score them (about 1.5 copies each).

    Fitting costs far more than its bytes suggest, so the number of partitions is given;
    Spark would merge them by size.
    """
    n, i = F.col("ordinal"), forest.interval
    first = F.floor(F.floor((n - 1) / i) / forest.block).cast("bigint")
    last = F.floor(F.floor((n + forest.window - 1) / i) / forest.block).cast("bigint")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = df.select("*", F.explode(F.sequence(first, last)).alias("_block"))
    return copies.repartition(parts, "ticker", "_block").groupBy("ticker", "_block")


def fitted(x: np.ndarray, ticker: str, version: int, forest: Forest):
    """A version's trees, their sample size and its cut-off."""
    psi = min(forest.sample, len(x))
    model = iforest.grow(x, forest.trees, forest.sample, iforest.seed_of(ticker, forest.seed, version))
    return model, psi, iforest.cut_off(iforest.score(x, *model, psi), forest.contamination)


def verdicts(raw: np.ndarray, offset: int) -> dict[str, np.ndarray]:
    """What is stored of scores in billionths under a version's cut-off."""
    above = raw * (iforest.CUT // iforest.BILLION) - offset
    return {
        "raw_score": raw / float(iforest.BILLION),
        "score": above / float(iforest.CUT),
        "is_anomaly": above < 0,
        "warming_up": np.zeros(len(raw), dtype=bool),
    }


WARMING = {"raw_score": 0.0, "score": 0.0, "is_anomaly": False, "warming_up": True}


def _versions(pdf: pd.DataFrame, forest: Forest) -> Iterator[tuple[int, np.ndarray, pd.DataFrame]]:
    """Version, training matrix and rows to score, for each version due in a block."""
    pdf = pdf.sort_values("ordinal", ignore_index=True)
    n = pdf["ordinal"].to_numpy()
    x = pdf[list(forest.features)].to_numpy(dtype=float)
    first = int(pdf["_block"].iloc[0]) * forest.block
    for v in range(first, first + forest.block):
        end = v * forest.interval
        if v and n[-1] < end:
            break
        lo, mid, hi = np.searchsorted(n, [end - forest.window, end, end + forest.interval], side="right")
        yield v, x[lo:mid], pdf.iloc[mid:hi]


SCORED = "version bigint, raw_score double, score double, is_anomaly boolean, warming_up boolean"


def scored_schema(forest: Forest) -> str:
    """What scoring gives: the row, its features, and the verdict."""
    features = "".join(f"{c} double, " for c in forest.features)
    return f"ticker string, ts_us bigint, seq bigint, ordinal bigint, {features}{SCORED}"


def score(df: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """Fit and score in one pass.

    ``df`` has ticker, ts_us, seq, ordinal and the features. Adds version, raw_score, score
    (raw_score above the version's cut-off), is_anomaly and warming_up. Rows before the
    first fit are warming up: score 0 and no anomaly.
    """
    keep = [*ID, "ordinal", *forest.features]
    out = scored_schema(forest)
    names = [c.split()[0] for c in out.split(", ")]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ticker = pdf["ticker"].iloc[0]
        parts = []
        for v, train, rows in _versions(pdf, forest):
            if not len(rows):
                continue
            if v == 0 or v * forest.interval < forest.warmup:
                parts.append(rows.assign(version=v, **WARMING))
                continue
            model, psi, offset = fitted(train, ticker, v, forest)
            raw = iforest.score(rows[list(forest.features)].to_numpy(dtype=float), *model, psi)
            parts.append(rows.assign(version=v, **verdicts(raw, offset)))
        if not parts:
            parts = [pdf.iloc[:0].assign(version=0, **WARMING)]
        return pd.concat(parts, ignore_index=True)[names]

    return _blocks(df.select(*keep), forest).applyInPandas(run, out)


MODEL = (
    "ticker string, version bigint, tree int, feature array<int>, threshold array<double>, "
    "value array<bigint>, psi int, offset bigint"
)


def fit(df: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """The forests themselves: one row per ticker, version and tree, nodes in heap order."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ticker = pdf["ticker"].iloc[0]
        rows = []
        for v, train, _ in _versions(pdf, forest):
            if v == 0 or v * forest.interval < forest.warmup:
                continue
            (f, t, val), psi, offset = fitted(train, ticker, v, forest)
            rows += [(ticker, v, i, f[i], t[i], val[i], psi, offset) for i in range(len(f))]
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in MODEL.split(", ")])
        return out.astype({"version": "int64", "tree": "int32", "psi": "int32", "offset": "int64"})

    keep = ["ticker", "ordinal", *forest.features]
    return _blocks(df.select(*keep), forest).applyInPandas(run, MODEL)


def nodes(models: DataFrame) -> DataFrame:
    """The forests node by node, in heap order: feature (-1 at a leaf), threshold, and the
    leaf's path length in billionths."""
    node = F.posexplode(F.arrays_zip("feature", "threshold", "value")).alias("node", "_n")
    rows = models.select("ticker", "version", "tree", node).select("ticker", "version", "tree", "node", "_n.*")
    return rows.filter((F.col("feature") >= 0) | (F.col("value") > 0))


def save(models: DataFrame, root: str) -> None:
    """Add forests to the saved ones, one folder per ticker."""
    models.write.mode("append").partitionBy("ticker").parquet(root)


def load(spark, root: str) -> DataFrame:
    """The saved forests; one saved again (it is the same one) counts once."""
    return spark.read.schema(MODEL).parquet(root).dropDuplicates(["ticker", "version", "tree"])


def newest(models: DataFrame) -> DataFrame:
    """The last version of each ticker's forest."""
    last = models.groupBy("ticker").agg(F.max("version").alias("version"))
    return models.join(last, ["ticker", "version"])


def score_with(df: DataFrame, models: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """Score rows with saved forests, each with the version that was valid at its ordinal.

    That is the version due before it or, where that was never saved, the newest earlier
    one that was. Rows are grouped by the version due, so a group has ``interval`` rows at
    most and gets one forest (100 small rows). Rows without an earlier forest are warming up.
    """
    names = list(forest.features)
    rows = df.select(*ID, "ordinal", *names, F.floor((F.col("ordinal") - 1) / forest.interval).cast("bigint").alias("_due"))
    # New names for both keys, as the rows they come from are on the other side of the cogroup.
    due = rows.select(F.col("ticker").alias("ticker"), F.col("_due").alias("ts_us")).distinct()
    held = models.select("ticker", "version").distinct()
    held = held.select("ticker", F.col("version").alias("ts_us"), F.lit(0).alias("seq"), "version")
    valid = last_known(due, held, value="version", bucket_s=1)  # a million versions a bucket
    valid = valid.filter("version IS NOT NULL").select("ticker", F.col("ts_us").alias("_due"), "version")
    spread = valid.join(models, ["ticker", "version"])
    out = f"ticker string, ts_us bigint, seq bigint, ordinal bigint, {SCORED}"
    cols = [c.split()[0] for c in out.split(", ")]

    def run(pdf: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        if not len(model):
            return pdf.assign(version=0, **WARMING)[cols]
        model = model.sort_values("tree")
        arrays = [np.stack(model[c].to_list()) for c in ("feature", "threshold", "value")]
        raw = iforest.score(pdf[names].to_numpy(dtype=float), *arrays, int(model["psi"].iloc[0]))
        return pdf.assign(version=int(model["version"].iloc[0]), **verdicts(raw, int(model["offset"].iloc[0])))[cols]

    left = rows.groupBy("ticker", "_due")
    return left.cogroup(spread.groupBy("ticker", "_due")).applyInPandas(run, out)


def flagged(scored: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """Anomaly rows as stored: score, features as a map, version, time."""
    hits = scored.filter(F.col("is_anomaly") & ~F.col("warming_up"))
    return as_map(hits, list(forest.features)).select(
        *ID, "score", "is_anomaly", "features", F.greatest("version", F.lit(1)).alias("model_version")
    )
