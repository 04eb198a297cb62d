"""Operational metrics as queries over logged values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.rules import ALERTS, window_start
from tickloom.session import checkpointed

SAMPLES = 100
HEALTHY_P99_MS = 200.0


def nearest_rank(values: Column, q: float) -> Column:
    """The value at position int(n * q) of a small sorted array."""
    n = F.size(values)
    return F.when(n > 0, F.element_at(values, F.least(F.floor(n * q).cast("int"), n - 1) + 1)).otherwise(F.lit(0.0))


def latency_stats(requests: DataFrame, as_of_us: int, samples: int = SAMPLES) -> DataFrame:
    """p50, p99 and mean of the last ``samples`` latencies, request and error counts.

    ``requests`` has ts_us, seq, latency_ms, status, is_external, is_static. The sample is
    the feature here: a distributed top-k, then one array of ``samples`` values.
    """
    counted = requests.filter(~F.col("is_static"))
    recent = (
        counted.filter(~F.col("is_external"))
        .orderBy(F.desc("ts_us"), F.desc("seq"))
        .select("latency_ms")
        .limit(samples)
        .agg(F.array_sort(F.collect_list("latency_ms")).alias("_v"))
    )
    totals = counted.agg(
        F.count("*").alias("total_requests"),
        F.count_if((F.col("ts_us") > as_of_us - 60_000_000) & (F.col("ts_us") <= as_of_us)).alias(
            "requests_per_minute"
        ),
        F.count_if(F.col("status") >= 400).alias("error_count"),
    )
    v = F.col("_v")
    n = F.size(v)
    total_ms = F.aggregate(v, F.lit(0).cast("decimal(38,8)"), lambda a, x: (a + x.cast("decimal(18,8)")).cast("decimal(38,8)"))
    p99 = nearest_rank(v, 0.99)
    one = F.lit(1).alias("_one")
    # Both sides are one row each.
    return (
        totals.withColumn("_one", one)
        .join(recent.withColumn("_one", one), "_one")
        .select(
            nearest_rank(v, 0.5).alias("p50_ms"),
            p99.alias("p99_ms"),
            F.when(n > 0, total_ms.cast("double") / n).otherwise(F.lit(0.0)).alias("mean_ms"),
            "total_requests",
            "requests_per_minute",
            "error_count",
            F.when(F.col("total_requests") > 0, F.col("error_count") / F.col("total_requests") * 100.0)
            .otherwise(F.lit(0.0))
            .alias("error_rate_pct"),
            F.when(p99 < HEALTHY_P99_MS, "healthy").otherwise("degraded").alias("status"),
        )
    )


def latency_by_key(log: DataFrame, quantiles: tuple[float, float] = (0.5, 0.99)) -> DataFrame:
    """p50 and p99 per key, exact over any amount of rows: the values of rank ceil(n * q).

    Rows are counted per key and whole millisecond first; only the milliseconds that hold
    a rank are looked into. No task sorts a key.
    """
    known = log.filter(F.col("latency_ms").isNotNull()).withColumn("_ms", F.floor("latency_ms"))
    whole = Window.partitionBy("key")
    counts = known.groupBy("key", "_ms").agg(F.count("*").alias("_n"))
    placed = counts.select(
        "key",
        "_ms",
        "_n",
        F.sum("_n").over(whole).alias("n"),
        (F.sum("_n").over(whole.orderBy("_ms")) - F.col("_n")).alias("_before"),
    )
    ranks = F.array(
        *[F.struct(F.lit(i).alias("i"), F.ceil(F.col("n") * q).alias("r")) for i, q in enumerate(quantiles)]
    )
    wanted = placed.withColumn("_q", F.explode(ranks)).select(
        "key", "_ms", "n", F.col("_q.i").alias("_i"), (F.col("_q.r") - F.col("_before")).alias("_r"), "_n"
    )
    wanted = wanted.filter((F.col("_r") > 0) & (F.col("_r") <= F.col("_n"))).drop("_n")
    values = known.join(wanted, ["key", "_ms"]).groupBy("key", "n", "_i", "_r", "latency_ms").agg(F.count("*").alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy("key", "_i").orderBy("latency_ms"))
    hit = values.withColumn("_u", upto).filter((F.col("_u") >= F.col("_r")) & (F.col("_u") - F.col("_c") < F.col("_r")))
    at = [F.max(F.when(F.col("_i") == i, F.col("latency_ms"))) for i in range(2)]
    return hit.groupBy("key").agg(at[0].alias("p50_ms"), at[1].alias("p99_ms"), F.max("n").alias("n"))


def consumer_lag(offsets: DataFrame) -> DataFrame:
    """Messages not yet read per topic; a partition never read counts in full."""
    behind = F.col("high") - F.coalesce("committed", "low")
    return offsets.groupBy("topic").agg(
        F.sum(F.greatest(F.lit(0).cast("bigint"), behind)).alias("lag"), F.count("*").alias("partitions")
    )


def metric_rollup(metrics: DataFrame, *dims: str, width_s: int = 10) -> DataFrame:
    """Long-form metrics (name, ts_us, value, dims) summed per flush window."""
    return metrics.groupBy("name", *dims, window_start("ts_us", width_s).alias("window_start_us")).agg(
        F.sum("value").alias("value"), F.count("*").alias("samples")
    )


def alert_levels(metrics: DataFrame) -> DataFrame:
    """Metric rows (name, value) with level ok, warning or critical; unknown names are ok."""
    limits = metrics.sparkSession.createDataFrame(ALERTS, "name string, warning double, critical double")
    level = F.when(F.col("value") >= F.col("critical"), "critical").when(F.col("value") >= F.col("warning"), "warning")
    # The limits are a fixed handful of rows.
    return (
        metrics.join(F.broadcast(limits), "name", "left")
        .withColumn("level", F.coalesce(level, F.lit("ok")))
        .drop("warning", "critical")
    )


def write_rates(log: DataFrame, key: Column, width_s: int = 1) -> DataFrame:
    """The busiest window of each write key, in writes per second."""
    per_window = log.groupBy(key.alias("pk"), window_start("ts_us", width_s).alias("_w")).agg(F.count("*").alias("_n"))
    return per_window.groupBy("pk").agg((F.max("_n") / float(width_s)).alias("peak_writes_per_s"), F.sum("_n").alias("writes"))


def feature_stats(df: DataFrame, cols: list[str], by: str = "ticker") -> DataFrame:
    """Mean and population deviation of each column per ticker."""
    aggs = [f(c).alias(f"{c}_{n}") for c in cols for n, f in (("mean", F.avg), ("std", F.stddev_pop))]
    return df.groupBy(by).agg(F.count("*").alias("n"), *aggs)


def standardize(df: DataFrame, stats: DataFrame, cols: list[str], by: str = "ticker") -> DataFrame:
    """(x - mean) / deviation per ticker; a deviation of 0 counts as 1."""
    small = checkpointed(stats.select(by, *[f"{c}_{n}" for c in cols for n in ("mean", "std")]))
    joined = df.join(small, by)
    scaled = {
        c: (F.col(c) - F.col(f"{c}_mean")) / F.when(F.col(f"{c}_std") == 0, 1.0).otherwise(F.col(f"{c}_std"))
        for c in cols
    }
    return joined.select(*[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns])
