from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Makes a documents table of texts, with ids from 0 on, or of (id, text) pairs."""

    def make(texts, schema=DOCS):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame(
            [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows], schema
        ).repartition(3)

    return make


@pytest.fixture
def crowded():
    """Adds columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    names = ("n", "set_id", "token", "bucket", "packed", "place", "rate", "n_tokens", "p0", "kept", "_kept", "piece", "vector")

    def add(df):
        return df.withColumns({c: F.lit("x") for c in names if c not in df.columns})

    return add
