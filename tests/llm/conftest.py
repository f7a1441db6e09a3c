import pytest
from pyspark.sql import functions as F

from railpulse.llm.queries import importable


@pytest.fixture(autouse=True)
def workers(spark):
    importable(spark)


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text) pairs, with columns whose names clash with
    those the operators use inside."""

    def make(rows):
        table = spark.createDataFrame(rows, "doc_id bigint, text string")
        return table.select(
            "doc_id",
            "text",
            F.lit("en").alias("lang"),
            F.when(F.col("doc_id") % 3 == 0, "a").when(F.col("doc_id") % 3 == 1, "b").alias("source"),
            F.length("text").cast("bigint").alias("n_chars"),
            *(F.lit("x").alias(n) for n in ("row", "fp", "size", "copies", "score", "_row", "key", "words")),
        )

    return make
