"""End-to-end analysis of many videos at once.

``run_analysis(videos, scorer)`` takes video records (see
``sources.io.VIDEO_SCHEMA``; one row per video, keyed by ``video_id``) and
returns a dict of DataFrames - one per output of the reference's stage chain
(chunks, relevant chunks, emotion predictions, relation scores, report tables,
rejected videos). Every text is scored once and the search runs once: its
result is written to the shared checkpoint folder, and the outputs are
projections and aggregates of that table.

A *scorer* is any object with ``score_text(df, text_col) -> df`` adding
``probs`` (array<double> over the six emotions) and ``top3``; see
``TextModelScorer`` (Spark ML pipeline from ``operators.train``). A
*vectoriser* for pairing is ``None`` (TF-IDF, built in) or any callable
``(df, text_col) -> df`` adding a dense ``vec`` column (e.g. an iterator
``pandas_udf`` that loads a sentence encoder once per worker).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reverbkit.constants import CES_LAMBDA, CHUNK_OVERLAP, CHUNK_WORDS, EMOTIONS, WRS_BETA
from reverbkit.functions import relations as R
from reverbkit.functions.text import valid_comments
from reverbkit.functions.vectors import argmax, top_k
from reverbkit.operators.chunks import chunk_text
from reverbkit.operators.pairing import nearest_chunk, tfidf_nearest_chunk
from reverbkit.operators.report import (
    comment_report,
    distribution,
    engagement_bands,
    engagement_metrics,
    overall_opinion,
)
from reverbkit.sources.io import require_columns


@dataclass
class TextModelScorer:
    """Adapts a fitted Spark ML pipeline (input column ``text``)."""

    model: PipelineModel
    names: list[str] | None = None

    def score_text(self, df: DataFrame, text_col: str) -> DataFrame:
        cols = df.columns
        x = df.withColumnRenamed(text_col, "text") if text_col != "text" else df
        out = self.model.transform(x).withColumn("probs", vector_to_array(F.col("probability")))
        out = out.select(*[("text" if c == text_col else c) for c in cols], "probs")
        if text_col != "text":
            out = out.withColumnRenamed("text", text_col)
        return out.withColumn("top3", top_k("probs", 3, self.names or EMOTIONS)).withColumn(
            "pred", argmax("probs")
        )


def video_comments(videos: DataFrame) -> DataFrame:
    """Comments exploded with their 1-based position, cleaned once."""
    c = videos.select("video_id", F.posexplode("comments").alias("pos", "raw_comment"))
    c = c.select("video_id", (F.col("pos") + 1).alias("comment_pos"), "raw_comment")
    return valid_comments(c, "raw_comment", "comment").select("video_id", "comment_pos", "comment")


PREDICTION_COLUMNS = (
    [f"comment_emotion{i}" for i in range(1, 4)] + [f"comment_conf{i}" for i in range(1, 4)]
    + [f"transcript_emotion{i}" for i in range(1, 4)] + [f"transcript_conf{i}" for i in range(1, 4)]
)


def _top3_from_columns(prefix: str):
    names = F.array(*[F.lit(e) for e in EMOTIONS])

    def one(i: int):
        e = F.col(f"{prefix}_emotion{i}").cast("string")
        pos = F.array_position(names, e)
        return F.struct(e.alias("emotion"), F.col(f"{prefix}_conf{i}").cast("double").alias("conf"),
                        F.when(pos > 0, (pos - 1).cast("int")).alias("idx"))

    return F.array(one(1), one(2), one(3))


def relation_scores_from_predictions(preds: DataFrame, lam: float = CES_LAMBDA,
                                     beta: float = WRS_BETA) -> DataFrame:
    """C1-C5 over the flattened predictions layout (six emotion and six
    confidence columns). All twelve columns are checked (S5); every other
    column (ids, texts) is passed through. An unknown emotion label gives
    null scores for that row instead of failing the job."""
    require_columns(preds, PREDICTION_COLUMNS)
    keep = [c for c in preds.columns if c not in PREDICTION_COLUMNS]
    x = preds.select(*keep, _top3_from_columns("comment").alias("ct"), _top3_from_columns("transcript").alias("tt"))
    x = x.withColumn("ces", R.ces_array("ct", "tt", lam))
    x = x.withColumn("WRS", R.wrs(F.col("ct"), F.col("tt"), F.col("ces"), beta))
    return x.select(
        *keep,
        R.final_emotion("ct", "ces").alias("final_emotion"),
        "WRS",
        R.ecf(F.col("WRS"), F.col("ct"), F.col("tt")).alias("ECF"),
        *[R.ces_for(e, "ct", "ces").alias(e) for e in EMOTIONS],
    )


def predictions_from(match: DataFrame, comments: DataFrame, chunks: DataFrame, scorer) -> DataFrame:
    """Distinct comments and chunks scored once each, joined
    to the nearest-chunk matches, flattened to the predictions layout."""
    distinct = comments.groupBy("video_id", "comment").agg(F.min("comment_pos").alias("comment_pos"))
    sc = scorer.score_text(distinct, "comment").select("video_id", "comment_pos", "comment",
                                                       F.col("top3").alias("comment_top3"))
    sk = scorer.score_text(chunks, "chunk").select("video_id", "chunk_index", "chunk", F.col("top3").alias("chunk_top3"))
    rel = match.select("video_id", "comment_pos", "chunk_index").join(sc, ["video_id", "comment_pos"]).join(
        sk, ["video_id", "chunk_index"])
    return _flatten_predictions(rel)


def _flatten_predictions(rel: DataFrame) -> DataFrame:
    return rel.select(
        "video_id", "comment_pos", "comment", F.col("chunk").alias("transcript_chunk"),
        *[F.element_at("comment_top3", i)["emotion"].alias(f"comment_emotion{i}") for i in range(1, 4)],
        *[F.element_at("comment_top3", i)["conf"].alias(f"comment_conf{i}") for i in range(1, 4)],
        *[F.element_at("chunk_top3", i)["emotion"].alias(f"transcript_emotion{i}") for i in range(1, 4)],
        *[F.element_at("chunk_top3", i)["conf"].alias(f"transcript_conf{i}") for i in range(1, 4)],
    )


def relate(comments: DataFrame, chunks: DataFrame, scorer,
           vectoriser: Callable[[DataFrame, str], DataFrame] | None = None,
           lam: float = CES_LAMBDA, beta: float = WRS_BETA) -> tuple[DataFrame, DataFrame]:
    """E3-E5 over cleaned comments (``video_id``, ``comment_pos``, ``comment``)
    and chunks (``video_id``, ``chunk_index``, ``chunk``) of many videos.

    Returns the scored chunks and one row per distinct comment: its nearest
    chunk with the chunk's text and emotions, both top-3 lists, ``ces``,
    ``wrs``, ``ecf`` and ``final_emotion``. Both are written once as parquet
    under the session's ``spark.checkpoint.dir``. The chunk's columns travel
    through the search, so nothing is joined by chunk afterwards."""
    from reverbkit.session import cut_lineage

    # Distinct comment texts per video, first position kept
    distinct = comments.groupBy("video_id", "comment").agg(F.min("comment_pos").alias("comment_pos"))
    # Each distinct comment and chunk scored once
    scored_comments = cut_lineage(scorer.score_text(distinct, "comment").select(
        "video_id", "comment_pos", "comment", F.col("top3").alias("comment_top3")), "comments")
    scored_chunks = cut_lineage(scorer.score_text(chunks, "chunk").select(
        "video_id", "chunk_index", "chunk", F.col("top3").alias("chunk_top3")), "chunks")

    # J2 + J4: nearest chunk per distinct comment, with both sides' columns
    carried = {"comment_payload": ["comment", "comment_top3"], "chunk_payload": ["chunk", "chunk_top3"]}
    if vectoriser is None:
        rel = tfidf_nearest_chunk(scored_comments, scored_chunks, "video_id", "comment_pos", "comment", "chunk", **carried)
    else:
        rel = nearest_chunk(vectoriser(scored_comments, "comment"), vectoriser(scored_chunks, "chunk"),
                            "video_id", "comment_pos", **carried)

    # C1-C4
    rel = rel.withColumn("ces", R.ces_array("comment_top3", "chunk_top3", lam))
    rel = rel.withColumn("wrs", R.wrs(F.col("comment_top3"), F.col("chunk_top3"), F.col("ces"), beta))
    rel = rel.withColumn("ecf", R.ecf(F.col("wrs"), F.col("comment_top3"), F.col("chunk_top3")))
    rel = rel.withColumn("final_emotion", R.final_emotion("comment_top3", "ces"))
    return scored_chunks, cut_lineage(rel, "relations")


def sentiment_rows(rel: DataFrame) -> DataFrame:
    """P4 / P8 for the rows of ``relate``."""
    top = F.element_at("comment_top3", 1)
    return rel.select(
        "video_id", "comment_pos", "comment",
        top["emotion"].alias("top_emotion"), top["conf"].alias("top_conf"),
        R.sentiment(top["emotion"], top["conf"]).alias("sentiment"),
    )


def run_analysis(videos: DataFrame, scorer, vectoriser: Callable[[DataFrame, str], DataFrame] | None = None,
                 chunk_size: int = CHUNK_WORDS, chunk_overlap: int = CHUNK_OVERLAP,
                 lam: float = CES_LAMBDA, beta: float = WRS_BETA) -> dict[str, DataFrame]:
    """The whole stage chain (E2 cleaning/chunking with ``chunk_size`` /
    ``chunk_overlap``, E3 pairing, E4 scoring, E5 relations with ``lam`` /
    ``beta``, E6 report tables) for every video at once.

    The cleaned comments and what ``relate`` returns are written once under
    the session's ``spark.checkpoint.dir`` at call time; every output reads
    those tables. Records that could not be parsed (``_corrupt_record``) are
    rejected as ``corrupt_record``."""
    from reverbkit.functions.text import clean_transcript, words
    from reverbkit.session import cut_lineage

    require_columns(videos, ["video_id", "transcript", "comments", "views", "likes", "comment_count", "subscriber_count"])
    n_words = videos.select("video_id", F.size(words(clean_transcript(F.col("transcript")))).alias("n_words"),
                            (F.col("_corrupt_record").isNotNull() if "_corrupt_record" in videos.columns
                             else F.lit(False)).alias("_corrupt"))
    comments = cut_lineage(video_comments(videos), "comments")
    scored_chunks, rel = relate(comments, chunk_text(videos, "video_id", "transcript", chunk_size, chunk_overlap),
                                scorer, vectoriser, lam, beta)

    # First failed check per video
    n_c = comments.groupBy("video_id").agg(F.count(F.lit(1)).alias("n_comments"))
    n_k = scored_chunks.groupBy("video_id").agg(F.count(F.lit(1)).alias("n_chunks"))
    checks = n_words.join(n_c, "video_id", "left").join(n_k, "video_id", "left")
    rejected = checks.select(
        "video_id",
        F.when(F.col("_corrupt"), F.lit("corrupt_record"))
        .when(F.col("n_words") == 0, F.lit("no_transcript"))
        .when(F.coalesce("n_comments", F.lit(0)) == 0, F.lit("no_comments"))
        .when(F.coalesce("n_chunks", F.lit(0)) == 0, F.lit("no_chunks")).alias("reason"),
    ).where(F.col("reason").isNotNull())

    relation_scores = rel.select(
        "video_id", "comment_pos", "final_emotion", F.col("wrs").alias("WRS"), F.col("ecf").alias("ECF"),
        *[R.ces_for(e, "comment_top3", "ces").alias(e) for e in EMOTIONS],
    )
    # P13, A1, A2, A4
    sent = sentiment_rows(rel)
    metrics = engagement_metrics(videos.select("video_id", "views", "likes", "comment_count", "subscriber_count"))
    return {
        "chunks": scored_chunks,
        "relevant_chunks": rel.select("video_id", "comment_pos", "chunk_index", "similarity"),
        "emotion_predictions": _flatten_predictions(rel),
        "relation_scores": relation_scores,
        "comment_report": comment_report(sent, ["video_id", "comment_pos", "comment"]),
        "sentiment_distribution": distribution(sent, "video_id", "sentiment"),
        "emotion_distribution": distribution(sent, "video_id", "top_emotion"),
        "overall_opinion": overall_opinion(sent, videos.select("video_id"), "video_id"),
        "engagement_metrics": metrics,
        "engagement_bands": engagement_bands(metrics),
        "rejected_videos": rejected,
    }


def reference_layout(outputs: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The stage files of the reference, with its column names, keyed by
    ``video_id`` (one folder per video when written partitioned):
    chunks, relevant_chunks, emotion_predictions and
    dependent_emotion_classification. Row indexes are the comment position
    and the chunk index."""
    ch = outputs["chunks"]
    preds = outputs["emotion_predictions"]
    rel = outputs["relation_scores"]
    return {
        "chunks": ch.select(
            "video_id", F.col("chunk_index").alias("row_index"), F.col("chunk").alias("Transcript Chunk"),
            *[F.element_at("chunk_top3", i)["emotion"].alias(f"transcript_emotion{i}") for i in range(1, 4)],
            *[F.element_at("chunk_top3", i)["conf"].alias(f"transcript_conf{i}") for i in range(1, 4)],
        ),
        "relevant_chunks": preds.select(
            "video_id", F.col("comment").alias("Comment"),
            F.col("transcript_chunk").alias("Most Relevant Transcript Chunk"),
        ),
        "emotion_predictions": preds.select("video_id", "comment", *PREDICTION_COLUMNS),
        "dependent_emotion_classification": rel.select(
            "video_id", F.col("comment_pos").alias("row_index"), "final_emotion", "WRS", "ECF", *EMOTIONS
        ),
    }


def write_reference_csv(outputs: dict[str, DataFrame], root: str) -> None:
    """Compatibility sink: ``<root>/<file>/video_id=<id>/part-*.csv`` with
    headers, one folder per video."""
    for name, df in reference_layout(outputs).items():
        (df.repartition("video_id").sortWithinPartitions("video_id").write.mode("overwrite").partitionBy("video_id").option("header", True)
         .option("quote", '"').option("escape", '"').csv(f"{root.rstrip('/')}/{name}"))


def write_outputs(outputs: dict[str, DataFrame], root: str) -> None:
    """One parquet dataset per output (each a separate job over the shared plan)."""
    for name, df in outputs.items():
        df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")


def rerun_analysis(videos: DataFrame, scorer, root: str, buckets: int | None = None, **settings) -> DataFrame:
    """E1 for what is new or changed since the last run under ``root`` (see
    ``sources.ledger``): the other videos' outputs are not touched. Terms weigh per
    video, so the rows equal those of a run over all. Returns the videos done."""
    from reverbkit.sources import ledger

    return ledger.rerun(videos, root, lambda todo: run_analysis(todo, scorer, **settings), buckets=buckets or ledger.BUCKETS)
