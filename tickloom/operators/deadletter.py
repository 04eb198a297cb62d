"""Dead letters: failed messages with context, their retry and their archive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.rules import iso_time, parse_time, timestamp
from tickloom.sources.schemas import LETTER_FIELDS

# Fixed values.
MAX_RETRIES = 3
NO_TICKER = "unknown"


def dead_letters(
    invalid: DataFrame,
    *,
    failed_us: Column,
    topic: Column | str = "market.trades",
    offset: Column | None = None,
    partition: Column | None = None,
    queue: Column | str = "validation",
    max_chars: int | None = None,
) -> DataFrame:
    """Failing rows (raw, error_field, error_reason, ticker) as dead letters of a queue.

    Messages are whole, so that they can be retried; ``max_chars`` cuts them for a sink
    that takes no more.
    """

    def lit(x: Column | str) -> Column:
        return F.lit(x) if isinstance(x, str) else x

    broken = F.col("error_field").isin("json", "unknown")
    return invalid.select(
        (F.col("raw") if max_chars is None else F.substring("raw", 1, max_chars)).alias("original_message"),
        "error_reason",
        F.when(broken, "JsonError").otherwise("ValidationError").alias("error_type"),
        lit(topic).alias("topic"),
        (F.lit(0) if offset is None else offset).cast("bigint").alias("offset"),
        (F.lit(0) if partition is None else partition).cast("int").alias("partition"),
        "ticker",
        F.lit(0).alias("retry_count"),
        failed_us.alias("first_failed_us"),
        failed_us.alias("last_failed_us"),
        lit(queue).alias("queue"),
    )


def attributes(df: DataFrame) -> DataFrame:
    """The message body as JSON next to the attributes a queue filters on."""
    body = F.struct(
        *[c for c in df.columns if c not in ("queue", "first_failed_us", "last_failed_us")],
        iso_time("first_failed_us").alias("first_failed_at"),
        iso_time("last_failed_us").alias("last_failed_at"),
    )
    return df.select(
        "queue",
        "error_type",
        F.coalesce("ticker", F.lit(NO_TICKER)).alias("ticker"),
        F.to_json(body).alias("body"),
    )


def read_bodies(df: DataFrame, body: str = "body", now_us: Column | None = None) -> DataFrame:
    """JSON bodies as dead letters; missing fields get defaults."""
    names = [f"_{c}" for c in LETTER_FIELDS]
    j = df.select("*", F.json_tuple(body, *LETTER_FIELDS).alias(*names))
    now = F.lit(None).cast("bigint") if now_us is None else now_us

    def text(c: str) -> Column:
        return F.coalesce(f"_{c}", F.lit("")).alias(c)

    def number(c: str, kind: str) -> Column:
        return F.coalesce(F.col(f"_{c}").try_cast(kind), F.lit(0).cast(kind)).alias(c)

    return j.select(
        *[c for c in df.columns if c != body],
        text("original_message"),
        text("error_reason"),
        text("error_type"),
        text("topic"),
        number("offset", "bigint"),
        number("partition", "int"),
        F.col("_ticker").alias("ticker"),
        number("retry_count", "int"),
        F.coalesce(parse_time("_first_failed_at"), now).alias("first_failed_us"),
        F.coalesce(parse_time("_last_failed_at"), now).alias("last_failed_us"),
    )


def retry(
    letters: DataFrame,
    process: Callable[[DataFrame], DataFrame],
    *,
    now_us: Column,
    max_retries: int = MAX_RETRIES,
) -> DataFrame:
    """Process dead letters again and say what becomes of each.

    ``process`` adds a boolean ``ok``. Adds ``action``: done, requeue or archive; failed
    letters have their retry count and last failure brought up to date.
    """
    done = process(letters)
    ok = F.coalesce("ok", F.lit(False))
    count = F.when(ok, F.col("retry_count")).otherwise(F.col("retry_count") + 1)
    action = F.when(ok, "done").when(count >= max_retries, "archive").otherwise("requeue")
    return done.select(
        *[c for c in letters.columns if c not in ("retry_count", "last_failed_us")],
        count.alias("retry_count"),
        F.when(ok, F.col("last_failed_us")).otherwise(now_us).alias("last_failed_us"),
        action.alias("action"),
    )


def archive_rows(letters: DataFrame) -> DataFrame:
    """Dead letters with the dated folder and the name they are archived under."""
    at = timestamp("last_failed_us")
    name = F.concat_ws(
        "_", F.coalesce("ticker", F.lit(NO_TICKER)), F.floor(F.col("last_failed_us") / 1_000_000).cast("string")
    )
    return letters.select(
        "*",
        F.date_format(at, "yyyy").alias("year"),
        F.date_format(at, "MM").alias("month"),
        F.date_format(at, "dd").alias("day"),
        name.alias("name"),
    )


def depth(letters: DataFrame) -> DataFrame:
    return letters.groupBy("queue").agg(F.count("*").alias("depth"))
