"""Report tables.

All group-bys here are on (video, small category) keys, so Spark's partial
aggregation collapses each task's rows before the shuffle; a hot video costs
one partial row per category per task, not its row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reverbkit.constants import ENGAGEMENT_BANDS
from reverbkit.functions.vectors import round_half_up

NA = "N/A"


def comment_report(scored: DataFrame, id_cols: list[str]) -> DataFrame:
    """P9 + P13: one row per comment with its top emotion, conf to 3 places, sentiment."""
    return scored.select(
        *id_cols,
        "top_emotion",
        round_half_up(F.col("top_conf"), 3).alias("confidence"),
        "sentiment",
    )


def distribution(scored: DataFrame, key: str, category: str) -> DataFrame:
    """A1 / A2: count per (video, category)."""
    return scored.groupBy(key, category).agg(F.count(F.lit(1)).alias("n"))


def overall_opinion(scored: DataFrame, videos: DataFrame, key: str = "video_id") -> DataFrame:
    """A4 for sentiment and top emotion; "N/A" for a video without comments.

    One pass: a GROUPING SETS aggregate counts per video, per (video,
    sentiment) and per (video, emotion) together; the modes (ties to the
    alphabetically first value) come from that small table.
    """
    counts = scored.groupingSets(
        [[key], [key, "sentiment"], [key, "top_emotion"]], key, "sentiment", "top_emotion"
    ).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("gid"))

    def mode(gid: int, col: str):
        cand = F.when(F.col("gid") == gid, F.struct((-F.col("n")).alias("neg"), F.col(col).alias("v")))
        return F.min(cand)["v"]

    per_video = counts.groupBy(key).agg(
        F.max(F.when(F.col("gid") == 3, F.col("n"))).alias("n_comments"),
        mode(1, "sentiment").alias("overall_sentiment"),
        mode(2, "top_emotion").alias("overall_emotion"),
    )
    out = videos.select(key).join(per_video, key, "left")
    return out.select(
        key,
        F.coalesce("n_comments", F.lit(0)).alias("n_comments"),
        F.coalesce("overall_sentiment", F.lit(NA)).alias("overall_sentiment"),
        F.coalesce("overall_emotion", F.lit(NA)).alias("overall_emotion"),
    )


def ratio_as_percentage(part, whole):
    """P10: round(part / whole * 100, 2); 0.0 when whole is 0 or null, or part is null."""
    pct = F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)
    return F.when((whole.isNull()) | (whole == 0) | part.isNull(), F.lit(0.0)).otherwise(
        round_half_up(pct, 2)
    )


def engagement_counts(events: DataFrame, key: str = "user_id") -> DataFrame:
    """Per video counts from an event log (view/click/purchase/signup)."""
    def n(kind):
        return F.sum(F.when(F.col("event_type") == kind, 1).otherwise(0)).cast("long")

    return events.groupBy(F.col(key).alias("video_id")).agg(
        n("view").alias("views"),
        n("click").alias("likes"),
        n("purchase").alias("comment_count"),
        n("signup").alias("subscriber_count"),
    )


def engagement_metrics(counts: DataFrame) -> DataFrame:
    """P10 + S7 defaults: the three engagement ratios per video."""
    c = counts.select(
        "video_id",
        *[F.coalesce(F.col(x), F.lit(0)).cast("long").alias(x)
          for x in ("views", "likes", "comment_count", "subscriber_count")],
    )
    return c.select(
        "*",
        ratio_as_percentage(F.col("likes"), F.col("views")).alias("likes_to_views_perc"),
        ratio_as_percentage(F.col("comment_count"), F.col("views")).alias("comments_to_views_perc"),
        ratio_as_percentage(F.col("views"), F.col("subscriber_count")).alias("views_to_subs_perc"),
    )


def engagement_bands(metrics: DataFrame) -> DataFrame:
    """P11 + P12: one row per (video, metric) with benchmark, band and gap.

    The three-row benchmark dimension is a literal ``stack``, so there is no
    join at all.
    """
    parts = []
    for name, bench, lo, hi in ENGAGEMENT_BANDS:
        parts += [f"'{name}'", name, f"CAST({bench} AS DOUBLE)", f"CAST({lo} AS DOUBLE)", f"CAST({hi} AS DOUBLE)"]
    stacked = metrics.selectExpr(
        "video_id",
        f"stack({len(ENGAGEMENT_BANDS)}, {', '.join(parts)}) AS (metric, value, benchmark, good_min, good_max)",
    )
    band = (
        F.when(F.col("value") < F.col("good_min"), F.lit("under"))
        .when(F.col("value") > F.col("good_max"), F.lit("over"))
        .otherwise(F.lit("good"))
    )
    return stacked.select(
        "video_id", "metric", "value", "benchmark", band.alias("band"),
        round_half_up(F.col("value") - F.col("benchmark"), 6).alias("gap"),
    )


def top_comments(comments: DataFrame, key: str, score: str, tie: str, n: int) -> DataFrame:
    """The n most popular comments per video (ties by ``tie``).

    ``row_number() <= n`` over a per-video window; Catalyst inserts a
    WindowGroupLimit below the shuffle, so every task ships at most n rows per
    video even for a hot video.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy(F.col(score).desc(), F.col(tie).asc())
    return comments.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
