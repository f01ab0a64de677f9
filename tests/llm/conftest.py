import pytest
from pyspark.sql import functions as F

TEXTS = ["one two three", None, "", "one two three", "  \n", "wort " * 3000, "Ünïcode 😀 日本 \u0000 x"]


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and long texts, repeated rows, extra and clashing columns."""
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, "one two three")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for extra in ("score", "component_id", "n", "h", "copies", "shard", "key", "row", "kind", "lang"):
        df = df.withColumn(extra, F.lit(None).cast("string"))
    return df.withColumn("n_chars", F.length("text").cast("long"))


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
