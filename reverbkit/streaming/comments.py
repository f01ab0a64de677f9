"""Structured Streaming entry points.

The reference is batch-only. Its row-wise operators (comment cleaning,
scoring, relation maths, sentiment) are stateless Column expressions, so they
run unchanged on ``readStream`` frames; the per-video engagement counts are a
streaming aggregation (update mode, state keyed by video). Checkpoints go to
the cluster's ``spark.checkpoint.dir`` so a restarted query resumes where it
stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reverbkit.functions import relations as R
from reverbkit.functions.text import clean_comment
from reverbkit.operators.report import engagement_counts
from reverbkit.session import checkpoint_dir

CONVERSATION_SCHEMA = "conv_id long, turn long, role string, text string"
EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def comment_stream(spark: SparkSession, source_dir: str, max_files: int = 1) -> DataFrame:
    """User turns of conversation parquet files arriving in ``source_dir``,
    cleaned (F10) as they arrive."""
    raw = spark.readStream.schema(CONVERSATION_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(source_dir)
    return raw.where(F.col("role") == "user").select(
        F.col("conv_id").alias("video_id"), F.col("turn").alias("comment_pos"),
        clean_comment(F.col("text")).alias("comment"),
    ).where(F.col("comment").isNotNull())


def scored_sentiment(scored: DataFrame) -> DataFrame:
    """P4 on a stream that carries ``comment_top3``."""
    top = F.element_at("comment_top3", 1)
    return scored.withColumn("sentiment", R.sentiment(top["emotion"], top["conf"]))


def engagement_stream(spark: SparkSession, source_dir: str) -> DataFrame:
    """Running view / like / comment / subscriber counts per video."""
    ev = spark.readStream.schema(EVENT_SCHEMA).parquet(source_dir)
    return engagement_counts(ev.select("user_id", "event_type"), "user_id")


def start(df: DataFrame, name: str, sink_dir: str | None = None, fmt: str = "parquet",
          mode: str = "append", available_now: bool = True) -> StreamingQuery:
    """Starts a query whose checkpoint lives under the shared checkpoint dir."""
    ckpt = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/stream-{name}"
    w = df.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", ckpt)
    if available_now:
        w = w.trigger(availableNow=True)
    if fmt == "memory":
        return w.format("memory").start()
    return w.format(fmt).start(sink_dir)
