"""Driver query of reruns of some videos (S4, E1), with its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reverbkit.session import checkpoint_dir
from reverbkit.sources.ledger import read_output, rerun
from reverbkit.sources.tables import table

BUCKETS = 16


def _turns(run: int):
    """Per turn its length, per conversation its turns; both say which run wrote them."""

    def analyse(videos: DataFrame) -> dict[str, DataFrame]:
        turns = videos.select("video_id", "turn", F.length("text").cast("long").alias("n_chars"), F.lit(run).alias("run"))
        per_video = turns.groupBy("video_id").agg(F.count(F.lit(1)).alias("n_turns"), F.sum("n_chars").alias("video_chars"), F.max("run").alias("run"))
        return {"turns": turns, "videos": per_video}

    return analyse


def q_rerun_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 + E1: all conversations but those of id 5 modulo 11; then all, those of 3
    modulo 7 with longer texts and those of 2 modulo 5 without their user turns; then
    the same again. Only new and changed ones are written anew."""
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("video_id"), "turn", "role", "text")
    then = c.where("video_id % 5 != 2 or role != 'user'").withColumn("text", F.when(F.col("video_id") % 7 == 3, F.concat("text", F.lit(" (edited)"))).otherwise(F.col("text")))
    root = f"{checkpoint_dir(spark).rstrip('/')}/tables/rerun-{uuid.uuid4().hex}"
    rerun(c.where("video_id % 11 != 5"), root, _turns(1), buckets=BUCKETS)
    for run in (2, 3):
        rerun(then, root, _turns(run), buckets=BUCKETS)
    turns, videos = read_output(spark, root, "turns"), read_output(spark, root, "videos")
    return turns.join(videos.withColumnRenamed("run", "video_run"), "video_id")


RERUN_QUERIES = {"rerun_outputs": q_rerun_outputs}

ORACLE_RERUN = {
    "rerun_outputs": """
WITH c AS (
  SELECT conv_id AS video_id, turn, CAST(length(text) + CASE WHEN conv_id % 7 = 3 THEN 9 ELSE 0 END AS BIGINT) AS n_chars,
    conv_id % 11 = 5 OR conv_id % 7 = 3 OR (conv_id % 5 = 2 AND bool_or(role = 'user') OVER (PARTITION BY conv_id)) AS again, role
  FROM conversations),
t AS (SELECT video_id, turn, n_chars, CAST(CASE WHEN again THEN 2 ELSE 1 END AS INTEGER) AS run FROM c WHERE video_id % 5 != 2 OR role != 'user')
SELECT video_id, turn, n_chars, run, count(*) OVER w AS n_turns, CAST(sum(n_chars) OVER w AS BIGINT) AS video_chars, run AS video_run
FROM t WINDOW w AS (PARTITION BY video_id)
""",
}
