"""Spark ML training, evaluation, save / load."""

import tempfile

from pyspark.sql import functions as F

from reverbkit.operators.train import ModelScorer, load_model, save_model, train_and_evaluate


def test_train_eval_save_load(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    lab = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select(
        "doc_id", F.col("quality").cast("int").alias("label"))
    model, metrics = train_and_evaluate(docs.join(lab, "doc_id"), names=["low", "high"])
    rows = {r.split: r for r in metrics.collect()}
    assert set(rows) == {"val", "test"}
    for r in rows.values():
        assert 0.0 <= r.accuracy <= 1.0 and r.log_loss >= 0.0 and r.n > 0
    path = tempfile.mkdtemp(prefix="reverbkit-model-") + "/m"
    save_model(model, path)
    again = ModelScorer(load_model(path)).score(docs.limit(20), ["low", "high"])
    first = ModelScorer(model).score(docs.limit(20), ["low", "high"])
    assert sorted(r.pred for r in again.collect()) == sorted(r.pred for r in first.collect())
