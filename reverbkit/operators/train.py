"""Classifier training, evaluation, persistence and scoring.

The reference fine-tunes a transformer on one GPU. Re-aimed for Spark: a
Spark ML ``Pipeline`` (regex tokenizer -> truncation -> hashing TF -> IDF ->
multinomial logistic regression with optional balanced class weights). The
driver only plans; gradients are computed on executors and combined by
tree aggregation, so training scales with the cluster.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reverbkit.functions.vectors import argmax, top_k
from reverbkit.operators.metrics import cross_entropy, weighted_metrics
from reverbkit.operators.prep import stratified_split

TOKEN_PATTERN = r"[\p{L}\p{N}]+"


def build_pipeline(text_col: str = "text", label_col: str = "label", max_tokens: int | None = None,
                   num_features: int = 1 << 16, weight_col: str | None = None,
                   max_iter: int = 30, reg: float = 0.01) -> Pipeline:
    """M4 + M6: tokenise (lower-case word runs), TF-IDF of unit length, and a
    multinomial logistic regression.

    Whole texts are used by default. ``max_tokens`` reproduces the
    reference's transformer input limit (128 in training, 64 in inference)
    when a caller wants exactly that; a TF-IDF model has no such limit.
    """
    tok = RegexTokenizer(inputCol=text_col, outputCol="_tokens", pattern=TOKEN_PATTERN, gaps=False,
                         toLowercase=True)
    stages = [tok]
    tokens = "_tokens"
    if max_tokens is not None:
        stages.append(SQLTransformer(
            statement=f"SELECT *, slice(_tokens, 1, {int(max_tokens)}) AS _tokens_cut FROM __THIS__"))
        tokens = "_tokens_cut"
    tf = HashingTF(inputCol=tokens, outputCol="_tf", numFeatures=num_features)
    idf = IDF(inputCol="_tf", outputCol="_tfidf")
    # unit length: a long text must not get extreme logits for its length
    unit = Normalizer(inputCol="_tfidf", outputCol="features")
    lr = LogisticRegression(featuresCol="features", labelCol=label_col, family="multinomial",
                            maxIter=max_iter, regParam=reg)
    if weight_col:
        lr.setWeightCol(weight_col)
    return Pipeline(stages=stages + [tf, idf, unit, lr])


def with_class_weights(df: DataFrame, label_col: str = "label", out: str = "weight") -> DataFrame:
    """A14 joined as a weight column. The weight table has one row per
    class, a bound set by the label domain, so it is broadcast."""
    from reverbkit.operators.prep import class_weights

    w = class_weights(df.select(label_col), label_col).select(label_col, F.col("weight").alias(out))
    return df.join(F.broadcast(w), label_col, "left")


@dataclass
class ModelScorer:
    """Scores text with a fitted pipeline; adds ``probs`` / ``top3`` / ``pred``."""

    model: PipelineModel

    def score(self, df: DataFrame, names: list[str] | None = None) -> DataFrame:
        out = self.model.transform(df).withColumn("probs", vector_to_array(F.col("probability")))
        keep = [c for c in df.columns] + ["probs"]
        out = out.select(*keep)
        return out.withColumn("top3", top_k("probs", 3, names)).withColumn("pred", argmax("probs"))


def save_model(model: PipelineModel, path: str) -> None:
    """M11."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def train_and_evaluate(labelled: DataFrame, key: str = "doc_id", text_col: str = "text",
                       label_col: str = "label", class_weighted: bool = True,
                       names: list[str] | None = None) -> tuple[PipelineModel, DataFrame]:
    """M6 + M7: stratified 70/15/15 split, fit on train, evaluate val and test.

    Returns the fitted model and one metrics row per evaluated split (n,
    accuracy, weighted precision/recall/F1, log loss, share of the most
    frequent class). The model is applied once to both splits; one partial
    aggregate per (split, label, prediction) feeds all metrics."""
    from reverbkit.session import cut_lineage

    # the split feeds training (many passes) and the evaluation: materialise
    # it once in the shared checkpoint folder
    split = cut_lineage(stratified_split(labelled, label_col, key))
    train = split.where(F.col("split") == "train")
    if class_weighted:
        train = with_class_weights(train, label_col, "weight")
    model = build_pipeline(text_col, label_col, weight_col="weight" if class_weighted else None).fit(train)
    held_out = split.where((F.col("split") != "train") & F.col(label_col).isNotNull())
    scored = ModelScorer(model).score(held_out, names)
    # (split, label, pred) cells: at most 2 x K x K rows
    cells = cut_lineage(
        scored.groupBy("split", F.col(label_col).alias("label"), "pred").agg(
            F.count(F.lit(1)).alias("n"), F.sum(cross_entropy(label_col, "probs")).alias("loss")), "cells")
    rows = []
    for name in ("val", "test"):
        part = cells.where(F.col("split") == name)
        m = weighted_metrics(part)
        ll = part.agg(F.sum("loss") / F.sum("n")).scalar()
        top = part.groupBy("label").agg(F.sum("n").alias("n")).agg(F.max("n") / F.sum("n")).scalar()
        rows.append(m.select(F.lit(name).alias("split"), "*", ll.alias("log_loss"), top.alias("majority")))
    return model, rows[0].unionByName(rows[1])
