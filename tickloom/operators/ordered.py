"""Time-ordered per-key computations that never put one whole key into one task.

``Window.partitionBy(key)`` sends every row of a key to a single task, so one busy key
stalls the job. Here a key's timeline is cut into time buckets and the window runs per
(key, bucket). What a bucket needs from the past arrives as a few *carry rows*:

* running and trailing sums: one row with the totals of all earlier buckets,
* row frames (``rows between n preceding``): the last ``n`` rows before the bucket,
* last known value: one row.

Carry rows come from a partial aggregate of one row per (key, bucket), so the data
itself is shuffled once. A bucket that is still too full is cut into narrower ones.

Trailing sums are a sweep: each row enters at its own time and leaves ``span`` later
with the opposite sign, and the trailing value is the running sum of those changes.
That costs O(1) per row, where a sliding frame costs O(rows in frame), and it needs no
copies of earlier rows however narrow the bucket is. Sums are exact (integers or
decimals), so entering and leaving cancel to zero.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BUCKET_S = 600
HOT_BUCKET_ROWS = 2_000_000

_BUCKET, _KIND, _AT = "_bucket", "_kind", "_at"
_ENTRY, _HISTORY = 0, -100


def hot_buckets(
    df: DataFrame, key: str, at: str, bucket_s: int, hot_rows: int | None
) -> DataFrame | None:
    """The (key, bucket) pairs with more than ``hot_rows`` rows and the width to cut them to.

    At most rows/hot_rows pairs can be that full, which bounds the broadcast of this table:
    20 MB for 10^12 rows. Raise ``hot_rows`` with the data beyond that. The width follows from the busiest of 6,000 slots of the
    bucket, so a burst of a few seconds is cut as well as an even stream. The second count
    reads rows of full buckets only; without any, Spark drops it at run time.
    """
    if hot_rows is None:
        return None
    width = bucket_s * 1_000_000
    slot = max(1, width // 6000)
    offset = F.pmod(F.col(at), F.lit(width))
    rows = df.select(
        F.col(key).alias("_hot_key"),
        (F.col(at) - offset).alias("_hot_start"),
        F.floor(offset / slot).alias("_slot"),
    )
    pair = ["_hot_key", "_hot_start"]
    full = rows.groupBy(*pair).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_rows).drop("_n")
    return (
        rows.join(F.broadcast(full), pair)
        .groupBy(*pair, "_slot")
        .agg(F.count("*").alias("_n"))
        .groupBy(*pair)
        .agg(F.max("_n").alias("_n"))
        .select(
            *pair,
            F.greatest(F.lit(1), F.least(F.lit(width), F.floor(F.lit(slot * hot_rows) / F.col("_n"))))
            .cast("bigint")
            .alias("_step"),
        )
    )


def with_bucket(df: DataFrame, hot: DataFrame | None, key: str, at: str, bucket_s: int) -> DataFrame:
    """Add ``_bucket``, the start (epoch µs) of the row's time bucket."""
    width = bucket_s * 1_000_000
    offset = F.pmod(F.col(at), F.lit(width))
    start = F.col(at) - offset
    if hot is None:
        return df.withColumn(_BUCKET, start)
    step = F.coalesce(F.col("_step"), F.lit(width))
    same = (F.col(key) == F.col("_hot_key")) & (start == F.col("_hot_start"))
    return df.join(F.broadcast(hot), same, "left").select(
        *df.columns, (start + offset - F.pmod(offset, step)).alias(_BUCKET)
    )


def _signed(kind_in: Sequence[int], kind_out: int, value: str) -> Column:
    v = F.col(value)
    return F.when(F.col(_KIND).isin(*kind_in), v).when(F.col(_KIND) == kind_out, -v)


def _history_rows(
    entries: DataFrame, key: str, ts: str, seq: str, n: int, cols: Sequence[str]
) -> DataFrame:
    """The last ``n`` rows of each key before each of its buckets."""
    picked = F.struct(ts, seq, *cols)
    if n == 1:
        tails = entries.groupBy(key, _BUCKET).agg(
            F.array(F.max_by(picked, F.struct(ts, seq))).alias("_tail")
        )
    else:
        newest = Window.partitionBy(key, _BUCKET).orderBy(F.desc(ts), F.desc(seq))
        tails = (
            entries.select(key, _BUCKET, ts, seq, *cols)
            .withColumn("_rn", F.row_number().over(newest))
            .filter(F.col("_rn") <= n)
            .groupBy(key, _BUCKET)
            .agg(F.sort_array(F.collect_list(picked)).alias("_tail"))
        )
    # Each earlier non-empty bucket holds at least one row, so n of them are enough.
    earlier = Window.partitionBy(key).orderBy(_BUCKET).rowsBetween(-n, -1)
    seen = F.flatten(F.collect_list("_tail").over(earlier))
    return (
        tails.select(key, _BUCKET, seen.alias("_seen"))
        .select(
            key,
            _BUCKET,
            F.explode(F.slice("_seen", F.greatest(F.size("_seen") - n + 1, F.lit(1)), n)).alias("_r"),
        )
        .select(key, _BUCKET, "_r.*", F.lit(_HISTORY).alias(_KIND), (F.col(_BUCKET) - 1).alias(_AT))
    )


def over_time(
    df: DataFrame,
    *,
    spans_s: Sequence[int] = (),
    measures: Mapping[str, Column] | None = None,
    history: int = 0,
    history_cols: Sequence[str] = (),
    row_exprs: Mapping[str, Callable[[WindowSpec], Column]] | None = None,
    key: str = "ticker",
    ts: str = "ts_us",
    seq: str = "seq",
    bucket_s: int = BUCKET_S,
    hot_rows: int | None = HOT_BUCKET_ROWS,
) -> DataFrame:
    """Add trailing sums and row-frame values; full rows are shuffled once.

    ``measures`` are summed over the closed range [t - span, t] of the key for every
    span, giving ``<measure>_<span>``. ``row_exprs`` build columns from a window ordered
    by (ts, seq) that sees the ``history`` rows before the current one.
    """
    measures = dict(measures or {})
    row_exprs = dict(row_exprs or {})
    names = {m: f"_m_{m}" for m in measures}
    rows = df.select("*", *[c.alias(names[m]) for m, c in measures.items()])

    events = [F.struct(F.lit(_ENTRY).alias(_KIND), F.col(ts).alias(_AT))] + [
        F.struct(F.lit(i).alias(_KIND), (F.col(ts) + s * 1_000_000 + 1).alias(_AT))
        for i, s in enumerate(spans_s, start=1)
    ]
    if len(events) > 1:
        # Leaving events carry the key and the measures only.
        rows = rows.withColumn("_e", F.explode(F.array(*events))).select(
            key,
            *[
                F.when(F.col(f"_e.{_KIND}") == _ENTRY, F.col(c)).alias(c)
                for c in df.columns
                if c != key
            ],
            *names.values(),
            "_e.*",
        )
    else:
        rows = rows.withColumn(_KIND, F.lit(_ENTRY)).withColumn(_AT, F.col(ts))
    hot = hot_buckets(rows, key, _AT, bucket_s, hot_rows)
    rows = with_bucket(rows, hot, key, _AT, bucket_s)

    parts = [rows]
    if spans_s:
        totals = rows.groupBy(key, _BUCKET).agg(
            *[
                F.sum(_signed([_ENTRY], i, names[m])).alias(f"{names[m]}_{i}")
                for i in range(1, len(spans_s) + 1)
                for m in measures
            ]
        )
        before = Window.partitionBy(key).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
        prefix = [
            F.sum(f"{names[m]}_{i}").over(before).alias(f"{names[m]}_{i}")
            for i in range(1, len(spans_s) + 1)
            for m in measures
        ]
        per_span = [
            F.struct(
                F.lit(-i).alias(_KIND), *[F.col(f"{names[m]}_{i}").alias(names[m]) for m in measures]
            )
            for i in range(1, len(spans_s) + 1)
        ]
        carried = (
            totals.select(key, _BUCKET, *prefix)
            .select(key, _BUCKET, F.explode(F.array(*per_span)).alias("_c"))
            .select(key, _BUCKET, "_c.*", (F.col(_BUCKET) - 1).alias(_AT))
        )
        parts.append(carried)
    if history:
        entries = with_bucket(df.select(key, ts, seq, *history_cols), hot, key, ts, bucket_s)
        parts.append(_history_rows(entries, key, ts, seq, history, list(history_cols)))

    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p, allowMissingColumns=True)

    # Both windows are partitioned alike, so the second one only sorts again.
    sums = {}
    if spans_s:
        upto = Window.partitionBy(key, _BUCKET).orderBy(_AT).rangeBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        sums = {
            f"{m}_{s}": F.sum(_signed([_ENTRY, -i], i, names[m])).over(upto)
            for i, s in enumerate(spans_s, start=1)
            for m in measures
        }
        both = both.select("*", *[c.alias(n) for n, c in sums.items()])
        both = both.filter(F.col(_KIND).isin(_ENTRY, _HISTORY))
    w = Window.partitionBy(key, _BUCKET).orderBy(ts, seq)
    return both.select(*df.columns, *sums, *[f(w).alias(c) for c, f in row_exprs.items()], _KIND).filter(
        F.col(_KIND) == _ENTRY
    ).drop(_KIND)


def running(
    df: DataFrame,
    measures: Mapping[str, Column],
    *,
    key: str = "ticker",
    ts: str = "ts_us",
    seq: str = "seq",
    bucket_s: int = BUCKET_S,
    hot_rows: int | None = HOT_BUCKET_ROWS,
) -> DataFrame:
    """Add running sums from the first row of the key up to and including this one."""
    names = {m: f"_m_{m}" for m in measures}
    rows = df.select("*", *[c.alias(names[m]) for m, c in measures.items()])
    rows = with_bucket(rows, hot_buckets(df, key, ts, bucket_s, hot_rows), key, ts, bucket_s)
    before = Window.partitionBy(key).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.groupBy(key, _BUCKET)
        .agg(*[F.sum(n).alias(n) for n in names.values()])
        .select(
            key,
            _BUCKET,
            *[F.sum(n).over(before).alias(n) for n in names.values()],
            (F.col(_BUCKET) - 1).alias(ts),
            F.lit(_HISTORY).alias(_KIND),
        )
    )
    upto = Window.partitionBy(key, _BUCKET).orderBy(ts, seq).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        rows.withColumn(_KIND, F.lit(_ENTRY))
        .unionByName(carried, allowMissingColumns=True)
        .select("*", *[F.sum(n).over(upto).alias(m) for m, n in names.items()])
        .filter(F.col(_KIND) == _ENTRY)
        .select(*df.columns, *measures)
    )


def last_known(
    left: DataFrame,
    right: DataFrame,
    *,
    key: str = "ticker",
    at: str = "ts_us",
    value: str,
    right_order: Sequence[str] = ("ts_us", "seq"),
    bucket_s: int = BUCKET_S,
    hot_rows: int | None = HOT_BUCKET_ROWS,
) -> DataFrame:
    """Add to each left row the newest right ``value`` of its key at or before it.

    ``right`` has ``key``, ``at``, the ordering columns and ``value`` (never null). The
    left rows get null where the key has no earlier right row.
    """
    order = F.struct(*[F.col(c) for c in right_order])
    r = right.select(key, at, order.alias("_ord"), F.col(value).alias("_val"), F.lit(0).alias(_KIND))
    rows = left.withColumn(_KIND, F.lit(1)).unionByName(r, allowMissingColumns=True)
    rows = with_bucket(rows, hot_buckets(rows, key, at, bucket_s, hot_rows), key, at, bucket_s)
    before = Window.partitionBy(key).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.groupBy(key, _BUCKET)
        .agg(
            F.max_by(
                F.when(F.col(_KIND) == 0, F.col("_val")),
                F.when(F.col(_KIND) == 0, F.struct(at, "_ord")),
            ).alias("_val")
        )
        .select(
            key,
            _BUCKET,
            F.last("_val", ignorenulls=True).over(before).alias("_val"),
            (F.col(_BUCKET) - 1).alias(at),
            F.lit(-1).alias(_KIND),
        )
    )
    upto = Window.partitionBy(key, _BUCKET).orderBy(at, _KIND, "_ord").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        rows.unionByName(carried, allowMissingColumns=True)
        .withColumn(value, F.last("_val", ignorenulls=True).over(upto))
        .filter(F.col(_KIND) == 1)
        .select(*left.columns, value)
    )
