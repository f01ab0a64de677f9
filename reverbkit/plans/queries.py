"""Driver queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every double that leaves a query is rounded to 6 places with
``floor(x * 1e6 + 0.5) / 1e6`` (the same in Spark and DuckDB), so engine
differences in float summation order never reach the comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reverbkit.constants import EMOTIONS
from reverbkit.functions import relations as R
from reverbkit.functions.vectors import round_half_up
from reverbkit.plans.emotion_flow import comment_matches, scored_rows

Query = Callable[[SparkSession, str], DataFrame]


def r6(c: Column | str) -> Column:
    return round_half_up(F.col(c) if isinstance(c, str) else c, 6)


def _flat_r6(top3: str, prefix: str) -> list[Column]:
    out = []
    for i in range(1, 4):
        out.append(F.element_at(F.col(top3), i)["emotion"].alias(f"{prefix}_emotion{i}"))
    for i in range(1, 4):
        out.append(r6(F.element_at(F.col(top3), i)["conf"]).alias(f"{prefix}_conf{i}"))
    return out


# ---------------------------------------------------------------------------
# embeddings flow
# ---------------------------------------------------------------------------

def q_nearest_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = comment_matches(spark, sf_dir)
    return m.select("video_id", "comment_id", "chunk_index", r6("similarity").alias("similarity"))


def q_top3_emotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, scorer = scored_rows(spark, sf_dir)
    from reverbkit.functions.vectors import argmax, top_k

    s = scorer.score(rows, "vec", "probs")
    s = s.select(
        "vec_id",
        "video_id",
        F.when(F.col("is_chunk"), F.lit("chunk")).otherwise(F.lit("comment")).alias("role"),
        top_k("probs", 3).alias("top3"),
        argmax("probs").alias("pred_label"),
    )
    return s.select("vec_id", "video_id", "role", *_flat_r6("top3", "top"), "pred_label")


def q_comment_chunk_emotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = comment_matches(spark, sf_dir)
    return m.select(
        "video_id", "comment_id", "chunk_index",
        *_flat_r6("comment_top3", "comment"), *_flat_r6("chunk_top3", "transcript"),
    )


def q_ces_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = comment_matches(spark, sf_dir)
    cols = []
    for i in range(1, 4):
        cols.append(F.element_at("comment_top3", i)["emotion"].alias(f"comment_emotion{i}"))
        cols.append(r6(F.element_at("ces", i)).alias(f"ces{i}"))
    return m.select("video_id", "comment_id", *cols)


def q_wrs_ecf(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = comment_matches(spark, sf_dir)
    return m.select("video_id", "comment_id", r6("wrs").alias("wrs"), "ecf")


def q_final_emotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = comment_matches(spark, sf_dir)
    top = F.element_at("comment_top3", 1)["emotion"]
    return m.select(
        "video_id", "comment_id", top.alias("top_emotion"), "final_emotion",
        (F.col("final_emotion") != top).alias("changed"),
    )


def q_ces_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = comment_matches(spark, sf_dir)
    per = [r6(R.ces_for(e, "comment_top3", "ces")).alias(e.lower()) for e in EMOTIONS]
    return m.select("video_id", "comment_id", "final_emotion", r6("wrs").alias("wrs"), "ecf", *per)


def _sentiment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reverbkit.functions.vectors import top_k
    from reverbkit.sources.tables import embedding_chunks, embedding_comments

    # only comments of videos with a transcript count; that needs no search
    rows, scorer = scored_rows(spark, sf_dir)
    comments = scorer.score(embedding_comments(rows), "vec", "_p").withColumn("comment_top3", top_k("_p", 3))
    m = comments.join(embedding_chunks(rows).select("video_id").distinct(), "video_id", "left_semi")
    top = F.element_at("comment_top3", 1)
    return m.select(
        "video_id", "comment_id",
        top["emotion"].alias("top_emotion"), top["conf"].alias("top_conf"),
        R.sentiment(top["emotion"], top["conf"]).alias("sentiment"),
    )


def q_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _sentiment_rows(spark, sf_dir)
    return s.select("video_id", "comment_id", "top_emotion", r6("top_conf").alias("top_conf"), "sentiment")


def q_comment_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reverbkit.operators.report import comment_report

    return comment_report(_sentiment_rows(spark, sf_dir), id_cols=["video_id", "comment_id"])


def q_sentiment_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reverbkit.operators.report import distribution

    return distribution(_sentiment_rows(spark, sf_dir), "video_id", "sentiment")


def q_emotion_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reverbkit.operators.report import distribution

    d = distribution(_sentiment_rows(spark, sf_dir), "video_id", "top_emotion")
    return d.withColumnRenamed("top_emotion", "emotion")


def q_overall_opinion(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reverbkit.operators.report import overall_opinion
    from reverbkit.sources.tables import embedding_rows

    videos = embedding_rows(spark, sf_dir).select("video_id").distinct()
    return overall_opinion(_sentiment_rows(spark, sf_dir), videos, "video_id")


# ---------------------------------------------------------------------------
# dataset preparation and evaluation (embeddings: label 0-5 = labelled set)
# ---------------------------------------------------------------------------

def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reverbkit.sources.tables import embedding_rows

    return embedding_rows(spark, sf_dir).where(F.col("label").isNotNull())


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reverbkit.functions.vectors import argmax

    rows, scorer = scored_rows(spark, sf_dir)
    lab = rows.where(F.col("label").between(0, len(EMOTIONS) - 1))
    return scorer.score(lab, "vec", "probs").withColumn("pred", argmax("probs"))


def q_label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reverbkit.operators.prep import label_distribution
    from reverbkit.sources.tables import embedding_rows

    return label_distribution(embedding_rows(spark, sf_dir).select("label"), "label")


def q_class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reverbkit.operators.prep import class_weights

    w = class_weights(_labelled(spark, sf_dir).select("label"), "label")
    return w.select("label", "n", r6("weight").alias("weight"))


def q_undersample(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reverbkit.operators.prep import undersample

    return undersample(_labelled(spark, sf_dir).select("vec_id", "label"), "label", "vec_id").select("vec_id", "label")


def q_stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reverbkit.operators.prep import stratified_split, undersample

    bal = undersample(_labelled(spark, sf_dir).select("vec_id", "label"), "label", "vec_id").select("vec_id", "label")
    return stratified_split(bal, "label", "vec_id").select("vec_id", "label", "split")


def q_confusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reverbkit.operators.metrics import confusion_counts

    return confusion_counts(_predictions(spark, sf_dir), "label", "pred")


def q_weighted_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reverbkit.operators.metrics import confusion_counts, weighted_metrics

    m = weighted_metrics(confusion_counts(_predictions(spark, sf_dir), "label", "pred"))
    return m.select("n", *[r6(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


def q_class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reverbkit.operators.metrics import class_report, confusion_counts

    rep = class_report(confusion_counts(_predictions(spark, sf_dir), "label", "pred"))
    return rep.select("class", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support")


def q_log_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reverbkit.operators.metrics import log_loss

    return log_loss(_predictions(spark, sf_dir), "label", "probs").select("n", r6("log_loss").alias("log_loss"))


QUERIES: dict[str, Query] = {
    "nearest_chunk": q_nearest_chunk,
    "top3_emotions": q_top3_emotions,
    "comment_chunk_emotions": q_comment_chunk_emotions,
    "ces_scores": q_ces_scores,
    "wrs_ecf": q_wrs_ecf,
    "final_emotion": q_final_emotion,
    "ces_table": q_ces_table,
    "sentiment": q_sentiment,
    "comment_report": q_comment_report,
    "sentiment_distribution": q_sentiment_distribution,
    "emotion_distribution": q_emotion_distribution,
    "overall_opinion": q_overall_opinion,
    "label_distribution": q_label_distribution,
    "class_weights": q_class_weights,
    "undersample": q_undersample,
    "stratified_split": q_stratified_split,
    "confusion_counts": q_confusion_counts,
    "weighted_metrics": q_weighted_metrics,
    "class_report": q_class_report,
    "log_loss": q_log_loss,
}
