"""Streaming forms of the operators.

A tick stream has ticker, price, size, ts_us, seq and the event time ``ts``; a news
stream has id, ticker, headline, summary, source, ts_us and ``ts``. Watermark delays say
how late a row may be; windows drop later rows, and ``start_late_split`` in front of them
keeps those as a table of their own.

Two steps hand rows on from one micro-batch to the next in folders of their own
(``start_ordered``, ``start_late_split``). A folder belongs to one batch; a batch that is
repeated after a failure finds its last folder complete, or does its work again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from tickloom.functions.exact import exact, notional, ratio
from tickloom.functions.rules import STRONG_SENTIMENT, UNUSUAL_Z, timestamp
from tickloom.operators import anomaly, correlate, deadletter, keyed, sentiment, validate
from tickloom.session import shared_folder
from tickloom.sources import sinks
from tickloom.streaming.state import OUTPUT, PIECE, AsOf, CutAnomalies, EnrichTicks, score_pieces

DELAY = "10 seconds"


def timed(df: DataFrame, delay: str = DELAY) -> DataFrame:
    """Add the event time ``ts`` with its watermark."""
    return df.withColumn("ts", timestamp()).withWatermark("ts", delay)


def _edges(df: DataFrame) -> DataFrame:
    return df.select(
        *[c for c in df.columns if c != "window"],
        F.unix_micros("window.start").alias("window_start_us"),
        F.unix_micros("window.end").alias("window_end_us"),
    )


def vwap(ticks: DataFrame, width_s: int = 60) -> DataFrame:
    """Tumbling VWAP, sent out when its window closes."""
    g = ticks.groupBy("ticker", F.window("ts", f"{width_s} seconds"))
    return _edges(
        g.agg(
            ratio(F.sum(notional()), F.sum("size")).alias("vwap"),
            F.sum("size").alias("volume"),
            F.count("*").alias("trade_count"),
        )
    )


def mean_price_hopping(ticks: DataFrame, width_s: int = 300, hop_s: int = 60) -> DataFrame:
    """Mean price over windows of ``width_s`` that start every ``hop_s``.

    Rows are summed per hop; the hops are summed to windows by their own time, so no row is
    copied and a ticker's state is a few sums per hop, however many ticks it has.
    """
    if hop_s <= 0 or width_s % hop_s:
        raise ValueError("width_s must be a multiple of hop_s")
    hops = ticks.groupBy("ticker", F.window("ts", f"{hop_s} seconds").alias("hop")).agg(
        F.sum(exact("price")).alias("_s"), F.count("*").alias("_n")
    )
    wide = F.window(F.window_time("hop"), f"{width_s} seconds", f"{hop_s} seconds")
    return _edges(
        hops.groupBy("ticker", wide).agg(
            (F.sum("_s").cast("double") / F.sum("_n")).alias("avg_price"), F.sum("_n").alias("trade_count")
        )
    )


def final_watermark(*tables: DataFrame, delay: str = DELAY) -> Column:
    """Where the watermark stands when streams over these finite tables end, in µs: the earliest one's."""
    ends = [t.agg(F.unix_micros(F.timestamp_micros(F.max("ts_us")) - F.expr(f"INTERVAL '{delay}'"))).scalar() for t in tables]
    return F.least(*ends) if len(ends) > 1 else ends[0]


def since(rows: DataFrame, mark: Column, span_s: int) -> DataFrame:
    """The rows that windows of ``span_s`` which end after ``mark`` can hold."""
    return rows.filter(F.col("ts_us") > mark - span_s * 1_000_000)


def with_open_windows(stored: DataFrame, last: DataFrame, mark: Column) -> DataFrame:
    """``stored`` with the windows that were still open when a finite stream ended.

    A window comes out when the watermark passes its end, so those of the last rows stay
    open. For this closing step ``last`` is the same operator's result in batch, over the
    rows ``since`` the watermark ``mark``.
    """
    keys = ["ticker", "window_start_us"]
    late = last.filter(F.col("window_end_us") > mark).join(stored.select(*keys), keys, "left_anti")
    return stored.unionByName(late)


def enrich(ticks: DataFrame) -> DataFrame:
    """Every tick with its live metrics, from per-ticker state.

    Within a micro-batch ticks are put in time order; a tick that comes in a later batch
    than its time is enriched from what is known then.
    """
    cols = ["ticker", "ts", "ts_us", "seq", "price", "size"]
    return (
        ticks.select(*cols)
        .groupBy("ticker")
        .transformWithStateInPandas(
            statefulProcessor=EnrichTicks(),
            outputStructType=OUTPUT,
            outputMode="Append",
            timeMode="EventTime",
            eventTimeColumnName="ts",
        )
    )


def score_news(news: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Sentiment per article; an article comes out once its time is past the watermark."""
    texts = sentiment.news_text(news)
    return sentiment.score(texts, lexicon, keys=("id", "ticker", "ts"))


def trade_windows(enriched: DataFrame, width_s: int = 60) -> DataFrame:
    return enriched.groupBy("ticker", F.window("ts", f"{width_s} seconds")).agg(
        F.max("volume_zscore").alias("max_zscore"), F.count("*").alias("trade_count")
    )


def news_windows(scored: DataFrame, width_s: int = 60) -> DataFrame:
    size = F.abs("compound")
    return scored.groupBy("ticker", F.window("ts", f"{width_s} seconds")).agg(
        F.max_by("compound", F.struct(size, "ts", "id")).alias("best_compound"),
        F.count("*").alias("news_count"),
        F.bool_or(size > STRONG_SENTIMENT).alias("had_strong_sentiment"),
    )


def correlations(ticks: DataFrame, news: DataFrame, lexicon: DataFrame, *, strong_only: bool = True) -> DataFrame:
    """Windows of both streams joined as they close."""
    return joined_windows(enrich(ticks), score_news(news, lexicon), strong_only=strong_only)


def joined_windows(enriched: DataFrame, scored: DataFrame, *, strong_only: bool = True) -> DataFrame:
    """The windows of enriched ticks and scored news, on streams or in batch."""
    joined = trade_windows(enriched).join(news_windows(scored), ["ticker", "window"])
    strong = F.col("had_strong_sentiment") & (F.col("max_zscore") > UNUSUAL_Z)
    out = joined.select(
        "ticker",
        "window",
        F.col("max_zscore").alias("volume_zscore"),
        F.col("best_compound").alias("sentiment_compound"),
        "trade_count",
        "news_count",
        strong.alias("is_strong"),
    )
    return _edges(out.filter("is_strong") if strong_only else out)


def asof(
    news: DataFrame, enriched: DataFrame, value: str = "volume_zscore", tolerance_s: int = 60, step_us: int = 1_000_000
) -> DataFrame:
    """Every article with the newest ``value`` of its ticker in the ``tolerance_s`` before
    it, null without one, sent out once the watermark is past the article.

    Times of articles count in whole steps, by default seconds as feeds give them: a value
    enters if it was there at the last full step. So a ticker's state is one value for each
    step of tolerance and delay. Ticks are thinned to one per step in the map tasks.
    """
    n = news.select(
        "ticker", "ts", F.lit(True).alias("is_news"), F.col("ts_us").alias("at"), F.lit(0).cast("bigint").alias("seq"),
        F.lit(None).cast("double").alias("value"), "id",
    )
    t = enriched.select(
        "ticker", "ts", F.lit(False).alias("is_news"), F.col("ts_us").alias("at"), "seq",
        F.col(value).alias("value"), F.lit(None).cast("bigint").alias("id"),
    )

    def thinned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b.sort_values(["at", "seq"], kind="stable")
            slot = -(-b["at"] // step_us)
            yield b[~pd.DataFrame({"t": b["ticker"], "s": slot}).duplicated(keep="last")]

    both = n.unionByName(t.mapInPandas(thinned, t.schema))
    out = both.groupBy("ticker").transformWithStateInPandas(
        statefulProcessor=AsOf(tolerance_s * 1_000_000, step_us),
        outputStructType=AsOf.OUT,
        outputMode="Append",
        timeMode="EventTime",
    )
    return out.withColumnRenamed("value", value)


def with_open_articles(
    news: DataFrame,
    matched: DataFrame,
    enriched: DataFrame,
    mark: Column,
    value: str = "volume_zscore",
    tolerance_s: int = 60,
) -> DataFrame:
    """``matched`` with the articles that still waited when a finite stream ended.

    ``asof`` sends an article out when the watermark is past it; later ones are matched here
    against ``enriched``, a table.
    """
    cols = ["id", "ticker", "ts_us"]
    rest = news.select(*cols).join(matched.select("id", "ticker"), ["id", "ticker"], "left_anti")
    late = correlate.asof_backward(
        rest.filter(F.col("ts_us") > mark - 1_000), since(enriched, mark, tolerance_s + 1), [value], tolerance_s=tolerance_s
    )
    return matched.select(*cols, value).unionByName(late.select(*cols, value))


def anomalies(features: DataFrame, forest: anomaly.Forest = anomaly.Forest()) -> DataFrame:
    """Score a feature stream (ticker, ts_us, seq and the features) with held forests.

    A ticker's forest stays in its state and is refitted when ``interval`` more events have
    come, wherever that falls in a micro-batch; scores equal those of ``anomaly.score``. The
    ticker's task only numbers rows and fits the forest it holds on; forests that come and go
    within a micro-batch are fitted by other tasks, each on a piece of fixed size, however
    busy the ticker is. Pieces are dealt out over four tasks a core.
    """
    pieces = (
        features.select(*anomaly.ID, *forest.features)
        .groupBy("ticker")
        .transformWithStateInPandas(
            statefulProcessor=CutAnomalies(forest),
            outputStructType=PIECE,
            outputMode="Append",
            timeMode="None",
        )
    )
    tasks = 4 * features.sparkSession.sparkContext.defaultParallelism
    dealt = pieces.repartitionById(tasks, F.pmod("slot", F.lit(tasks)).cast("int"))
    return dealt.mapInPandas(score_pieces(forest), anomaly.scored_schema(forest))


def first_seen(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key within the watermark delay; memory is bounded by time."""
    return df.dropDuplicatesWithinWatermark(list(keys))


def _launch(spark: SparkSession, writer: DataStreamWriter, partitions: int | None = None) -> StreamingQuery:
    """Start a query with ``partitions`` state partitions, by default no more than the cluster has cores.

    A new query takes its partition count from ``spark.sql.shuffle.partitions`` and keeps
    it for good, and each partition of each stateful step is a store that is committed in
    every micro-batch. A job that starts small and is to grow should name its count.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, partitions or min(int(before), spark.sparkContext.defaultParallelism))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, before)


def start(
    df: DataFrame, root: str, *, name: str, trigger: dict | None = None, partitions: int | None = None
) -> StreamingQuery:
    """Append a stream to Parquet files, exactly once."""
    writer = (
        df.writeStream.format("parquet")
        .option("path", f"{root}/data")
        .option("checkpointLocation", f"{root}/checkpoint")
        .queryName(name)
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": "5 minutes"}))
    )
    return _launch(df.sparkSession, writer, partitions)


def start_archive(ticks: DataFrame, root: str, checkpoint: str, *, trigger: dict | None = None) -> StreamingQuery:
    """Archive a tick stream under year/month/day/hour folders."""
    writer = (
        sinks.dated(ticks)
        .writeStream.format("parquet")
        .partitionBy(*sinks.HOUR_PARTS)
        .option("path", root)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 minutes"}))
    )
    return _launch(ticks.sparkSession, writer)


def start_insert_if_absent(
    df: DataFrame, root: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], *, trigger: dict
) -> StreamingQuery:
    """Insert new keys of a stream into a day-partitioned table; replays add nothing."""

    def put(batch: DataFrame, _: int) -> None:
        rows = batch.persist()
        try:
            sinks.append_new(rows, root, keys, order)
        finally:
            rows.unpersist()

    writer = df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(**trigger)
    return _launch(df.sparkSession, writer)


def start_split(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    *,
    trigger: dict,
    check: Callable[[DataFrame], DataFrame] = validate.market_events,
    queue: str = "validation",
) -> StreamingQuery:
    """Raw messages (raw, topic, partition, offset, received_us) forked into valid rows and dead letters.

    ``check`` is ``validate.market_events`` or ``validate.news_events``. Each micro-batch writes its own folders and overwrites them when it is repeated.
    """

    def fork(batch: DataFrame, batch_id: int) -> None:
        checked = check(batch).persist()
        try:
            valid = validate.valid_only(checked).drop("raw")
            valid.write.mode("overwrite").parquet(f"{root}/valid/batch={batch_id}")
            letters = deadletter.dead_letters(
                validate.invalid_only(checked),
                failed_us=F.col("received_us"),
                topic=F.col("topic"),
                offset=F.col("offset"),
                partition=F.col("partition"),
                queue=queue,
            )
            letters.write.mode("overwrite").parquet(f"{root}/dead_letters/batch={batch_id}")
        finally:
            checked.unpersist()

    writer = messages.writeStream.foreachBatch(fork).option("checkpointLocation", checkpoint).trigger(**trigger)
    return _launch(messages.sparkSession, writer)


def _folder(root: str, what: str, batch_id: int) -> str:
    return f"{root}/{what}/batch={batch_id}"


def _complete(spark: SparkSession, folder: str) -> bool:
    """Was this folder written to its end?"""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def _handed(spark: SparkSession, root: str, what: str, batch_id: int, schema: StructType) -> DataFrame | None:
    """What the batch before handed on; None for the first batch."""
    if batch_id == 0:
        return None
    folder = _folder(root, what, batch_id - 1)
    if not _complete(spark, folder):
        raise FileNotFoundError(f"{folder} is missing, and this batch goes on from it")
    return spark.read.schema(schema).parquet(folder)


def start_ordered(
    ticks: DataFrame,
    root: str,
    checkpoint: str,
    operator: Callable[..., DataFrame],
    *,
    span_s: int,
    rows: int,
    trigger: dict,
    bucket_s: int = 60,
    hot_rows: int = 100_000,
    partitions: int | None = None,
) -> StreamingQuery:
    """Run a time-ordered batch operator (one of ``rolling``) over a stream.

    A micro-batch is worked on together with what was handed on: each ticker's ticks of the
    last ``span_s`` seconds and its last ``rows`` ticks. The operator cuts a ticker's time
    into buckets, and buckets of more than ``hot_rows`` ticks further, so a ticker with a
    third of the ticks spreads over tasks; there is no per-ticker list. Results are under
    ``root``/out (``ordered_stream`` reads them on). A tick that comes in a later batch than
    its time is worked on with what is known then.
    """
    spark = ticks.sparkSession
    cols = list(ticks.columns)

    def step(batch: DataFrame, batch_id: int) -> None:
        if _complete(spark, _folder(root, "handed", batch_id)):
            return  # a repeated batch; its results may have been read already
        batch.write.mode("overwrite").parquet(_folder(root, "in", batch_id))
        new = spark.read.schema(batch.schema).parquet(_folder(root, "in", batch_id))
        old = _handed(spark, root, "handed", batch_id, batch.schema)
        both = new.withColumn("_new", F.lit(True))
        if old is not None:
            both = both.unionByName(old.withColumn("_new", F.lit(False)))
        done = operator(both, bucket_s=bucket_s, hot_rows=hot_rows).filter("_new").drop("_new")
        done.write.mode("overwrite").parquet(_folder(root, "out", batch_id))
        both = both.drop("_new")
        last = both.groupBy("ticker").agg((F.max("ts_us") - span_s * 1_000_000).alias("_from"))
        recent = both.join(last, "ticker")
        tail = keyed.latest_n(recent.filter(F.col("ts_us") < F.col("_from")), rows).select(*cols)
        tail = tail.unionByName(recent.filter(F.col("ts_us") >= F.col("_from")).select(*cols))
        tail.write.mode("overwrite").parquet(_folder(root, "handed", batch_id))

    writer = ticks.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**trigger)
    return _launch(spark, writer, partitions)


def ordered_stream(spark: SparkSession, root: str, schema: StructType | str, **options) -> DataFrame:
    """What ``start_ordered`` or ``start_late_split`` wrote to ``root``, as a stream again."""
    return spark.readStream.schema(schema).options(recursiveFileLookup=True, **options).parquet(root)


def start_late_split(
    ticks: DataFrame, root: str, checkpoint: str, *, delay_s: int = 10, trigger: dict, ts: str = "ts_us"
) -> StreamingQuery:
    """Fork a stream into rows on time and late rows, so that none is lost.

    A row is late if its time lies more than ``delay_s`` before the latest time of the
    micro-batches before its own: the rows a window with that watermark delay might drop.
    They are under ``root``/late, the others under ``root``/on_time.
    """
    spark = ticks.sparkSession
    kind = StructType().add("mark", "long")

    def step(batch: DataFrame, batch_id: int) -> None:
        if _complete(spark, _folder(root, "mark", batch_id)):
            return
        batch.write.mode("overwrite").parquet(_folder(root, "in", batch_id))
        new = spark.read.schema(batch.schema).parquet(_folder(root, "in", batch_id))
        old = _handed(spark, root, "mark", batch_id, kind)
        mark = None if old is None else old.first()["mark"]
        late = F.lit(False) if mark is None else F.coalesce(F.col(ts) < mark, F.lit(False))
        new.filter(~late).write.mode("overwrite").parquet(_folder(root, "on_time", batch_id))
        new.filter(late).write.mode("overwrite").parquet(_folder(root, "late", batch_id))
        least = F.lit(mark).cast("bigint")
        seen = new.agg(F.greatest(F.max(ts) - delay_s * 1_000_000, least).alias("mark"))
        seen.write.mode("overwrite").parquet(_folder(root, "mark", batch_id))

    writer = ticks.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**trigger)
    return _launch(spark, writer)


def run_once(df: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is there now and give back what it wrote."""
    spark = df.sparkSession
    root = shared_folder(spark, name)
    q = start(df, root, name=name, trigger={"availableNow": True})
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{root}/data")
