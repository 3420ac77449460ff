"""Helpers of the training-data tests."""

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
# Names that operators use inside, or that need quoting, as columns of a table.
CLASHING = ("id", "row", "key", "fp", "sha", "n", "score", "lang_pred", "head", "d", "unit", "batch", "a.b", "two words", "clean")


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang) rows, with clashing extra columns on request."""

    def make(rows, clash=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if clash:
            from pyspark.sql import functions as F

            df = df.select("*", *[F.lit(1).alias(c) for c in CLASHING])
        return df

    return make
