"""Stateless cleaning and the engagement aggregate on streams."""

import tempfile
import uuid

from reverbkit.streaming.comments import comment_stream, engagement_stream, start


def test_comment_stream_matches_batch(spark):
    from reverbkit.functions.text import clean_comment
    from pyspark.sql import functions as F

    src = tempfile.mkdtemp(prefix="reverbkit-stream-src-")
    conv = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    conv.repartition(3).write.mode("overwrite").parquet(src + "/in")
    name = f"comments_{uuid.uuid4().hex[:8]}"
    q = start(comment_stream(spark, src + "/in"), name, fmt="memory")
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.sql(f"SELECT * FROM {name}").collect())
    want = sorted(
        tuple(r) for r in conv.where("role = 'user'").select(
            F.col("conv_id").alias("video_id"), F.col("turn").alias("comment_pos"),
            clean_comment(F.col("text")).alias("comment")).where("comment IS NOT NULL").collect())
    assert got == want and len(got) > 0


def test_engagement_stream(spark):
    src = tempfile.mkdtemp(prefix="reverbkit-stream-ev-")
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.repartition(2).write.mode("overwrite").parquet(src + "/in")
    name = f"eng_{uuid.uuid4().hex[:8]}"
    q = start(engagement_stream(spark, src + "/in"), name, fmt="memory", mode="complete")
    q.awaitTermination(120)
    n = spark.sql(f"SELECT sum(views) AS v FROM {name}").first().v
    assert n == ev.where("event_type = 'view'").count()
