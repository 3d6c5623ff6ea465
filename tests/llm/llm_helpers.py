"""Fixture and helper of the tests in this folder."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture()
def make_docs(spark):
    """Documents from (doc_id, text[, lang[, source]]) tuples, in 3 partitions."""
    def make(rows, extra=None):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a",
                 None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            from pyspark.sql import functions as F
            for name in extra:
                df = df.withColumn(name, F.lit("own"))
        return df.repartition(3) if rows else df
    return make


def collect(df, *cols):
    return sorted((tuple(r[c] for c in (cols or df.columns)) for r in df.collect()), key=repr)
