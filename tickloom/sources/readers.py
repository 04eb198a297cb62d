"""Readers. Schemas are always given, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.keyed import between
from tickloom.sources.schemas import BAR
from tickloom.sources.sinks import HOUR_PARTS


def kafka_messages(
    spark: SparkSession, servers: str, topic: str, *, starting: str = "latest", max_per_trigger: int | None = None
) -> DataFrame:
    """A message stream: key, value (bytes), topic, partition, offset, timestamp.

    ``max_per_trigger`` bounds what one micro-batch reads. Needs Spark's Kafka package.
    """
    r = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_per_trigger)
    return r.load()


def file_stream(
    spark: SparkSession, path: str, schema: str, fmt: str = "parquet", *, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Files of a folder as a stream."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def bars_csv(spark: SparkSession, path: str, schema: str = BAR) -> DataFrame:
    """Daily bars from CSV files with a header."""
    return spark.read.csv(path, header=True, schema=schema)


def archive(spark: SparkSession, root: str, schema: str, **parts: str) -> DataFrame:
    """The Parquet archive; ``parts`` (year, month, day, hour) pick folders, others are not read."""
    full = schema + "".join(f", {p} string" for p in HOUR_PARTS)
    df = spark.read.schema(full).parquet(root)
    for p, v in parts.items():
        df = df.filter(F.col(p) == v)
    return df


def keyed_rows(
    df: DataFrame, ticker: str, *, start_us: int | None = None, end_us: int | None = None, newest: int | None = None
) -> DataFrame:
    """One key's rows by time range, newest first if a number is given."""
    d = between(df.filter(F.col("ticker") == ticker), start_us, end_us)
    return d if newest is None else d.orderBy(F.desc("ts_us"), F.desc("seq")).limit(newest)
