import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents-like table from texts (ids 0.. in order, or ``(id, text)`` pairs)."""
    def make(texts, langs=None):
        rows = []
        for i, t in enumerate(texts):
            i, t = t if isinstance(t, tuple) else (i, t)
            rows.append((i, t, langs[len(rows)] if langs else "en", "s", len(t or "")))
        return spark.createDataFrame(rows, DOCS)
    return make


@pytest.fixture(scope="session")
def with_clashes():
    """Adds columns named like the operators' own results and helpers."""
    from pyspark.sql import functions as F

    def add(df, *names):
        for n in ("n_words", "text_key", "spans", "items", "key", "count", "col", "kept", "start",
                  "component", "_hit_id", "word", *names):
            df = df.withColumn(n, F.lit("x"))
        return df
    return add
