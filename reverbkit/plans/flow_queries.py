"""Driver queries over the whole chain: conversations as videos, user turns as
comments, assistant turns as transcript, a scorer by text length."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reverbkit.constants import EMOTIONS
from reverbkit.functions import relations as R
from reverbkit.functions.vectors import round_half_up, softmax, top_k
from reverbkit.operators.report import overall_opinion
from reverbkit.plans.flow import _flatten_predictions, relate, sentiment_rows
from reverbkit.plans.text_queries import cleaned_comments, transcript_chunks
from reverbkit.sources.tables import conversation_videos


class LengthScorer:
    """Logit of class i: (length * i) modulo 7. Deterministic, so SQL can repeat it."""

    def score_text(self, df: DataFrame, text_col: str) -> DataFrame:
        logits = F.array(*[((F.length(text_col) * i) % 7).cast("double") for i in range(1, len(EMOTIONS) + 1)])
        return df.withColumn("_lg", logits).withColumn("probs", softmax("_lg")).drop("_lg").withColumn("top3", top_k("probs", 3))


def _relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relate(cleaned_comments(spark, sf_dir), transcript_chunks(spark, sf_dir), LengthScorer())[1]


def q_flow_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _flatten_predictions(_relations(spark, sf_dir))
    return p.select(*[round_half_up(F.col(c), 6).alias(c) if "_conf" in c else c for c in p.columns])


def q_flow_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rel = _relations(spark, sf_dir)
    per = [round_half_up(R.ces_for(e, "comment_top3", "ces"), 6).alias(e.lower()) for e in EMOTIONS]
    return rel.select("video_id", "comment_pos", "final_emotion", round_half_up(F.col("wrs"), 6).alias("wrs"), "ecf", *per)


def q_flow_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overall_opinion(sentiment_rows(_relations(spark, sf_dir)), conversation_videos(spark, sf_dir), "video_id")


FLOW_QUERIES = {
    "flow_predictions": q_flow_predictions,
    "flow_relations": q_flow_relations,
    "flow_report": q_flow_report,
}
