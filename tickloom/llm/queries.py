"""All text queries, the pipeline included, and their SQL twins."""

from __future__ import annotations

import corpus_pipeline
from tickloom.llm import native, reports, scans, substrings  # noqa: F401
from tickloom.plans.catalogue import Query


def load() -> dict[str, Query]:
    return native.QUERIES | {"pipeline": Query(corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)}
