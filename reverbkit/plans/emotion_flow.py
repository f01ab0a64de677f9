"""The flagship flow: which comments disagree with what was said?

embeddings -> centroid scorer -> top-3 per comment and per chunk ->
nearest chunk per comment -> CES / WRS / mismatch flag.

Shuffles, in order: (1) the centroid aggregate (partial, bounded output,
inlined as a scalar subquery); (2) packing chunks into blocks per video;
(3) the salted comment x block join (or a broadcast when AQE sees a small
block side); (4) the per-comment max (partial aggregate, one row per comment
leaves each task). Scoring and relation maths are narrow projections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reverbkit.functions import relations as R
from reverbkit.functions.vectors import top_k
from reverbkit.operators.pairing import nearest_chunk
from reverbkit.operators.scoring import CentroidScorer
from reverbkit.sources.tables import embedding_chunks, embedding_comments, embedding_rows


def scored_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, CentroidScorer]:
    rows = embedding_rows(spark, sf_dir)
    return rows, CentroidScorer.fit(rows)


def comment_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per comment: nearest chunk, both top-3 lists, CES, WRS, ECF."""
    rows, scorer = scored_rows(spark, sf_dir)
    comments = scorer.score(embedding_comments(rows), "vec", "_p").withColumn("comment_top3", top_k("_p", 3))
    chunks = scorer.score(embedding_chunks(rows), "vec", "_p").withColumn("chunk_top3", top_k("_p", 3))
    m = nearest_chunk(
        comments, chunks, key="video_id", comment_key="comment_id",
        comment_payload=["comment_top3"], chunk_payload=["chunk_top3"],
    )
    ces = R.ces_array("comment_top3", "chunk_top3")
    m = m.withColumn("ces", ces)
    w = R.wrs(F.col("comment_top3"), F.col("chunk_top3"), F.col("ces"))
    return (
        m.withColumn("wrs", w)
        .withColumn("ecf", R.ecf(F.col("wrs"), F.col("comment_top3"), F.col("chunk_top3")))
        .withColumn("final_emotion", R.final_emotion("comment_top3", "ces"))
    )
