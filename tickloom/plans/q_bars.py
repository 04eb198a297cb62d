"""Daily bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import bars, keyed
from tickloom.plans.catalogue import query
from tickloom.plans.views import sql
from tickloom.session import shared_folder
from tickloom.sources import adapters as src
from tickloom.sources import readers, sinks

PIVOT = 50
_COLS = "open, high, low, close, adj_close, nullif(volume, 0) AS volume, close_usd"


def _clean(spark, d):
    return bars.clean(src.bars_raw(spark, d), PIVOT)


def _iso(df):
    return df.withColumn("date", F.col("date").cast("string"))


@query(sql("bars", f'SELECT "index", d::VARCHAR AS date, {_COLS} FROM bars'))
def bars_clean(spark, d):
    """Raw bars written as CSV files with a header, read back and cleaned."""
    root = shared_folder(spark, "bars-csv")
    sinks.write_csv(src.bars_raw(spark, d), root)
    return _iso(bars.clean(readers.bars_csv(spark, root), PIVOT))


@query(
    sql(
        "bars",
        """SELECT concat_ws(',', "index", d::VARCHAR, open::VARCHAR, high::VARCHAR, low::VARCHAR, close::VARCHAR, adj_close::VARCHAR,
       coalesce(nullif(volume, 0)::VARCHAR, 'N/A'), close_usd::VARCHAR) AS line FROM bars""",
    )
)
def bars_to_csv_lines(spark, d):
    return bars.to_lines(_clean(spark, d))


@query(sql("bars", f'SELECT "index", d::VARCHAR AS date, {_COLS} FROM bars'))
def bars_from_csv_lines(spark, d):
    return _iso(bars.from_lines(bars.to_lines(_clean(spark, d))))


@query(
    sql(
        "bars",
        """SELECT "index", d::VARCHAR AS date, CASE WHEN day(d) % 3 = 0 THEN close + 1 ELSE close END AS close,
       CASE WHEN day(d) % 3 = 0 THEN 2 ELSE 1 END::BIGINT AS version FROM bars""",
    )
)
def bars_upsert(spark, d):
    """Bars delivered again with corrections for every third day."""
    b = _clean(spark, d).select("index", "date", "close", F.lit(1).cast("bigint").alias("version"))
    fixed = b.filter(F.dayofmonth("date") % 3 == 0).withColumn("close", F.col("close") + 1).withColumn(
        "version", F.lit(2).cast("bigint")
    )
    return _iso(keyed.upsert(b, fixed, ["index", "date"], ["version"]))
