"""Daily bars: cleaning and CSV messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.sources.schemas import BAR

COLUMNS = ["index", "date", "open", "high", "low", "close", "adj_close", "volume", "close_usd"]
NO_VOLUME = "N/A"


def bar_date(date: Column | str = "date", pivot: int = 0) -> Column:
    """d/m/yy text to a date. Years below ``pivot`` are 20yy, the rest 19yy."""
    parts = F.split(date, "/")
    year = F.get(parts, 2).cast("int")
    year = year + F.when(year < pivot, 2000).otherwise(1900)
    return F.make_date(year, F.get(parts, 1).cast("int"), F.get(parts, 0).cast("int"))


def clean(df: DataFrame, pivot: int = 0) -> DataFrame:
    """Real dates, and volume 0 as missing."""
    volume = F.col("volume").cast("string").try_cast("bigint")
    return df.withColumn("date", bar_date(pivot=pivot)).withColumn("volume", F.nullif(volume, F.lit(0).cast("bigint")))


def to_lines(df: DataFrame) -> DataFrame:
    """Bars as comma-separated messages, missing volume as N/A."""
    cells = [
        F.coalesce(F.col(c).cast("string"), F.lit(NO_VOLUME if c == "volume" else "")) for c in COLUMNS
    ]
    return df.select(F.concat_ws(",", *cells).alias("line"))


def from_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """Comma-separated messages as bars (ISO dates); quoted cells are understood."""
    b = df.select(F.from_csv(line, BAR).alias("_b")).select("_b.*")
    return b.withColumn("date", F.col("date").try_cast("date")).withColumn(
        "volume", F.col("volume").try_cast("bigint")
    )
