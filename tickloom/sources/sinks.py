"""Writers. All of them can be repeated without doubling rows or run from ``foreachBatch``."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.functions.rules import timestamp
from tickloom.operators.deadletter import archive_rows as dead_letter_archive_rows
from tickloom.operators.keyed import insert_if_absent, keep_first, keep_last
from tickloom.session import fine_shuffles

HOUR_PARTS = ["year", "month", "day", "hour"]
DAY_PARTS = ["year", "month", "day"]


def dated(df: DataFrame, parts: Sequence[str] = HOUR_PARTS, ts: str = "ts_us") -> DataFrame:
    """Add the folder columns of each row's own time."""
    formats = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    return df.select("*", *[F.date_format(timestamp(ts), formats[p]).alias(p) for p in parts])


def write_archive(df: DataFrame, root: str, max_records: int = 5_000_000) -> None:
    """Append to the Parquet archive under year/month/day/hour.

    The rebalance hint gathers each hour's rows before the write, and cuts a busy hour
    into several files, so neither tiny nor huge files come out.
    """
    (
        dated(df)
        .hint("rebalance", *HOUR_PARTS)
        .write.mode("append")
        .option("maxRecordsPerFile", max_records)
        .partitionBy(*HOUR_PARTS)
        .parquet(root)
    )


def register(spark: SparkSession, table: str, root: str, columns: str) -> None:
    """Make an archive folder a catalogue table and find its partitions."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, year string, month string, day string, hour string) "
        f"USING parquet PARTITIONED BY ({', '.join(HOUR_PARTS)}) LOCATION '{root}'"
    )
    spark.catalog.recoverPartitions(table)


def existing(spark: SparkSession, root: str, schema: StructType) -> DataFrame | None:
    """The table in a folder, or None if nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(root)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def append_new(
    incoming: DataFrame, root: str, keys: Sequence[str], order: Sequence[str], ts: str = "ts_us"
) -> None:
    """Insert rows whose key is not in the table yet. A replayed batch adds nothing.

    The table is partitioned by day; only the days of the batch are compared.
    """
    spark = incoming.sparkSession
    new = dated(incoming, DAY_PARTS, ts)
    old = existing(spark, root, new.schema)
    if old is None:
        new = keep_first(new, keys, order)
    else:
        days = new.select(*DAY_PARTS).distinct()
        new = insert_if_absent(new, old.join(days, DAY_PARTS, "left_semi"), keys, order)
    new.write.mode("append").partitionBy(*DAY_PARTS).parquet(root)


def upsert(
    incoming: DataFrame, table: str, root: str, keys: Sequence[str], version: Sequence[str], ts: str = "ts_us"
) -> None:
    """Put rows into a catalogue table of days, the highest version per key wins.

    Only the days of the batch are rewritten, and into a new folder below ``root``; the
    table's days are then pointed to it one by one. Whatever fails before that leaves the
    table as it was, and a batch that failed in between is finished by putting it again.
    Folders that no day points to any more may be removed once no reader needs them. A
    key's rows must be of one day; put the time or the day into the key.

    The batch is written once below ``root``/new, so that it is computed once, and shuffles
    are cut finely, so that a task's share does not grow with the batch or the days.
    """
    spark = incoming.sparkSession
    new = dated(incoming, DAY_PARTS, ts)
    put = uuid.uuid4().hex[:12]
    with fine_shuffles(spark):
        new.write.parquet(f"{root}/new/{put}")
    new = spark.read.schema(new.schema).parquet(f"{root}/new/{put}")
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new.schema)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({', '.join(DAY_PARTS)}) LOCATION '{root}/days'")
    days = new.select(*DAY_PARTS).distinct()
    old = spark.table(table).select(*new.columns).join(days, DAY_PARTS, "left_semi")
    staged = f"{root}/puts/{put}"
    with fine_shuffles(spark):
        keep_last(old.unionByName(new), list(keys), list(version)).write.partitionBy(*DAY_PARTS).parquet(staged)
    _switch(spark, table, staged, days.orderBy(*DAY_PARTS).collect())  # a row a day


def _switch(spark: SparkSession, table: str, staged: str, days: Sequence[Row]) -> None:
    """Point days of a table to staged folders."""
    for day in days:
        spec = ", ".join(f"{p} = '{day[p]}'" for p in DAY_PARTS)
        folder = staged + "".join(f"/{p}={day[p]}" for p in DAY_PARTS)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{folder}'")
        spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)


def write_dead_letters(letters: DataFrame, root: str) -> None:
    """Append dead letters, one folder per queue."""
    letters.write.mode("append").partitionBy("queue").parquet(root)


def archive_dead_letters(letters: DataFrame, root: str) -> None:
    """Write dead letters as JSON under the day of their last failure."""
    dead_letter_archive_rows(letters).write.mode("append").partitionBy(*DAY_PARTS).json(root)


def as_messages(df: DataFrame, key: str = "ticker") -> DataFrame:
    """key and JSON value columns, as message sinks take them."""
    return df.select(F.col(key).alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def publish(df: DataFrame, servers: str, topic: str) -> None:
    """Write to a Kafka topic, keyed by ticker (needs Spark's Kafka package)."""
    as_messages(df).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def write_csv(df: DataFrame, root: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(root)
