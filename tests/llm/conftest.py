from __future__ import annotations

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringledger.llm.common import prepared, stored

#: Names the operators use inside, or put out themselves.
CLASHING = ("row", "key", "band", "at", "score", "kept", "blob", "findings", "piece", "tokens", "text_a", "_row", "_text", "lang_pred")


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    return prepared(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table of (doc_id, text) rows, with more columns whose names clash."""

    def make(*entries: tuple, lang: str | None = "en") -> DataFrame:
        df = spark.createDataFrame([(e[0], e[1]) for e in entries], "doc_id bigint, text string").repartition(3)
        df = df.withColumns(
            {"lang": F.lit(lang).cast("string"), "source": F.lit("s"), "n_chars": F.length("text").cast("bigint")}
        )
        return stored(df.withColumns({name: F.lit(7) for name in CLASHING}), "test-documents")

    return make


@pytest.fixture(scope="session")
def small(spark, sf_dir):
    """The smallest given documents table and its rows."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df, {r["doc_id"]: r["text"] for r in df.collect()}
