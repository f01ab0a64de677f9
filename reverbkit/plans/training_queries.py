"""Driver queries of classifier training and evaluation."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reverbkit.constants import EMOTIONS
from reverbkit.functions.vectors import round_half_up
from reverbkit.operators import minibatch
from reverbkit.operators.prep import stratified_split, undersample
from reverbkit.session import checkpoint_dir, cut_lineage
from reverbkit.sources.tables import embedding_rows, table

VECTOR_DIMS = 64
VECTOR_SETTINGS = minibatch.Settings(epochs=5, batches=4, rate=0.05)
TEXT_DIMS = 1024
TEXT_SETTINGS = minibatch.Settings(epochs=5, batches=8, rate=0.1)
MEASURES = ("train_loss", "loss", "accuracy", "precision", "recall", "f1", "majority")


def _told(spark: SparkSession, model: minibatch.SoftmaxModel) -> DataFrame:
    rows = minibatch.history(model, spark)
    return rows.select("split", "epoch", *[round_half_up(F.col(c), 6).alias(c) for c in MEASURES], "n")


def emotion_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled embeddings, balanced and split."""
    rows = embedding_rows(spark, sf_dir).where(F.col("label").between(0, len(EMOTIONS) - 1)).select("vec_id", "label", "vec")
    split = stratified_split(undersample(rows, "label", "vec_id").drop("rank"), "label", "vec_id")
    return cut_lineage(split.select("vec_id", "label", "split", minibatch.vector_features("vec").alias("features")), "emotions")


def q_train_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 + M7: the emotion head; a row per epoch and one for the test split."""
    return _told(spark, minibatch.train(emotion_rows(spark, sf_dir), "vec_id", len(EMOTIONS), VECTOR_DIMS, VECTOR_SETTINGS)[0])


def train_quality(spark: SparkSession, sf_dir: str) -> tuple[minibatch.SoftmaxModel, DataFrame]:
    """Documents of low and high quality, told apart by their terms."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("label")).where("label is not null")
    split = cut_lineage(stratified_split(docs.join(lab, "doc_id"), "label", "doc_id"), "split")
    rows = minibatch.text_features(split, "doc_id", "text", TEXT_DIMS, split.where("split = 'train'"))
    return minibatch.train(rows, "doc_id", 2, TEXT_DIMS, TEXT_SETTINGS)


def q_train_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 + M7 on texts: a row per epoch and one for the test split."""
    return _told(spark, train_quality(spark, sf_dir)[0])


def q_reloaded_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7 + M11: the emotion head, saved to the shared folder and loaded again, on
    every labelled test vector."""
    rows = emotion_rows(spark, sf_dir)
    path = f"{checkpoint_dir(spark).rstrip('/')}/models/{uuid.uuid4().hex}"
    minibatch.save(minibatch.train(rows, "vec_id", len(EMOTIONS), VECTOR_DIMS, VECTOR_SETTINGS)[0], spark, path)
    scored = minibatch.predict(rows.where("split = 'test'"), minibatch.load(spark, path), ["vec_id", "label"])
    probs = [round_half_up(F.col("probs")[k], 6).alias(f"p{k}") for k in range(len(EMOTIONS))]
    return scored.select("vec_id", "label", "pred", *probs, round_half_up(F.col("loss"), 6).alias("loss"))


TRAINING_QUERIES = {
    "train_history": q_train_history,
    "train_eval": q_train_eval,
    "reloaded_scores": q_reloaded_scores,
}
