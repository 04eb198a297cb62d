"""Registry of runnable queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tickloom.session import configure

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


CATALOGUE: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Run], Run]:
    """Register a query under its function's name; ``sql`` is the same result in DuckDB."""

    def add(fn: Run) -> Run:
        key = name or fn.__name__
        if key in CATALOGUE:
            raise ValueError(f"query {key} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        CATALOGUE[key] = Query(run, sql)
        return fn

    return add


def load() -> dict[str, Query]:
    """Import every module that registers queries."""
    from tickloom.plans import (  # noqa: F401
        q_anomaly,
        q_bars,
        q_monitor,
        q_news,
        q_records,
        q_rolling,
        q_serving,
        q_sinks,
        q_streams,
        q_windows,
    )

    return CATALOGUE
