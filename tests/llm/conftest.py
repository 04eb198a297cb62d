import random

import pytest
from pyspark.sql import DataFrame

from tickloom.session import configure

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def texts(spark):
    """A function from texts (or (id, text) pairs) to a documents table."""
    configure(spark)

    def make(rows, parts: int = 3, more: dict | None = None) -> DataFrame:
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        full = [(i, t, "en", f"s{(i or 0) % 3}" if i != 1 else None, len(t or "")) for i, t in rows]
        df = spark.createDataFrame(full, DOCS).repartition(parts)
        for name, column in (more or {}).items():
            df = df.withColumn(name, column)
        return df

    return make


@pytest.fixture(scope="session")
def prose():
    """Random prose of made-up words, with the seed given."""

    def make(seed: int, words: int, vocabulary: int = 3000) -> str:
        r = random.Random(seed)
        known = ["".join(random.Random(k).choices("abcdefghijklmnoprstuvw", k=3 + k % 7)) for k in range(vocabulary)]
        return " ".join(r.choices(known, k=words))

    return make
