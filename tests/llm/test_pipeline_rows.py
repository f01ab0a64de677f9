"""Rows that repeat ids, lack them, or bring columns of clashing names."""

import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F
from reverbkit.llm import pii

TEXT = "the quick brown fox jumps over the lazy dog and runs far away from here today"


def test_near_copies_of_repeated_and_missing_ids(spark):
    other, third = "completely different words stand in this other text, nothing is shared at all", "yet one more text that is of no kin to either of the two above it, really not"
    rows = [(5, TEXT), (5, other), (5, TEXT), (7, TEXT), (None, TEXT), (None, third), (None, third), (2, other), (9, None), (8, "")]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, row int").withColumn("row_key", F.lit("x")).withColumn("component_id", F.lit(0))
    for parts in (1, 6):
        got = cp.drop_near_copies(spark, docs.repartition(parts), "")
        assert got.columns == docs.columns
        assert sorted((r["doc_id"] or -1, r["text"] or "") for r in got.collect()) == sorted([(5, TEXT), (2, other), (-1, third), (8, "")])


def test_pii_with_a_column_of_that_name(spark):
    docs = spark.createDataFrame([(1, "mail a.b@example.org now", 3), (2, None, 4)], "doc_id long, text string, n_entities int").withColumn("n_chars", F.lit(0).cast("long"))
    with pytest.raises(ValueError):
        pii.replace_pii(docs)
    assert {r["doc_id"]: r["found"] for r in pii.replace_pii(docs, count_col="found").collect()} == {1: 1, 2: 0}
    out = cp.replace_private(spark, docs.select("doc_id", "text", "n_entities", "n_chars"), "").collect()
    assert {r["doc_id"]: r["n_entities"] for r in out} == {1: 3, 2: 4} and "a.b@example.org" not in out[0]["text"] + (out[1]["text"] or "")
