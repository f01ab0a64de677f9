"""Readers for the test tables and the role mapping onto the video model.

Roles (stated once here, mirrored by the oracle SQL):

* ``embeddings``: ``vec_id % 10 = 0`` are transcript chunks, the rest
  comments; ``video_id = (vec_id div 10) % 5``; a chunk's ``chunk_index`` is
  ``vec_id div 50 + 1`` (dense, 1-based within its video); rows with
  ``label`` 0-5 are the labelled set that defines the emotion centroids.
* ``conversations``: ``conv_id`` is the video; ``user`` turns are comments
  (position = ``turn``), ``assistant`` turns are transcript segments in
  ``turn`` order; ``system`` turns are dropped.
* ``documents``: each ``doc_id`` is one transcript.
* ``events``: per ``user_id`` (the video) ``view`` / ``click`` /
  ``purchase`` / ``signup`` counts are views / likes / comments / subscribers.

Only the columns a query needs are selected, so parquet column pruning and
filter pushdown reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reverbkit.functions.vectors import as_doubles

N_VIDEOS_EMB = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def embedding_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        "vec_id",
        F.col("label").cast("int").alias("label"),
        as_doubles("embedding").alias("vec"),
        F.pmod(F.expr("vec_id div 10"), F.lit(N_VIDEOS_EMB)).alias("video_id"),
        (F.pmod(F.col("vec_id"), F.lit(10)) == 0).alias("is_chunk"),
    )


def embedding_comments(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("is_chunk")).select("video_id", F.col("vec_id").alias("comment_id"), "vec", "label")


def embedding_chunks(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("is_chunk")).select(
        "video_id",
        (F.expr("vec_id div 50") + 1).cast("int").alias("chunk_index"),
        F.col("vec_id").alias("chunk_id"),
        "vec",
    )


def conversation_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.where(F.col("role") == "user").select(
        F.col("conv_id").alias("video_id"), F.col("turn").alias("comment_pos"), F.col("text").alias("raw_comment")
    )


def conversation_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.where(F.col("role") == "assistant").select(
        F.col("conv_id").alias("video_id"), F.col("turn").alias("seg_idx"), F.col("text").alias("segment")
    )


def conversation_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("video_id")).distinct()
