"""Command line: the stage entry points, each a Spark job.

    python -m reverbkit clean     --input VIDEOS --output DIR [--chunk_length 64 --chunk_overlap 16]
    python -m reverbkit pair      --input DIR --output DIR
    python -m reverbkit infer     --input DIR --output DIR --model MODEL
    python -m reverbkit relations --input PREDICTIONS --output DIR [--format csv|parquet]
    python -m reverbkit analyze   --input VIDEOS --output DIR --model MODEL [--rerun]
    python -m reverbkit train     --input LABELLED --output MODEL [--format csv|parquet]

VIDEOS is a folder of video-record JSON files; DIR outputs are parquet
folders. ``relations`` accepts the flattened predictions layout
(comment_emotion1..3, comment_conf1..3, transcript_emotion1..3,
transcript_conf1..3) as parquet or CSV. ``analyze --rerun`` works on the videos
that are new or changed since the last such run and rewrites only their buckets.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F


def _spark():
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("reverbkit").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="reverbkit")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("clean", "pair", "infer", "relations", "analyze", "train"):
        p = sub.add_parser(name)
        p.add_argument("--input", required=True)
        p.add_argument("--output", required=True)
        p.add_argument("--model")
        p.add_argument("--format", default="parquet", choices=["parquet", "csv"])
        p.add_argument("--rerun", action="store_true")
        p.add_argument("--chunk_length", type=int, default=64)
        p.add_argument("--chunk_overlap", type=int, default=16)
    a = ap.parse_args(argv)
    spark = _spark()

    from reverbkit.operators.chunks import chunk_text
    from reverbkit.plans import flow
    from reverbkit.sources import io as IO

    if a.cmd == "clean":
        videos = IO.read_videos(spark, a.input)
        comments = flow.video_comments(videos)
        chunks = chunk_text(videos, "video_id", "transcript", a.chunk_length, a.chunk_overlap)
        IO.write_table(comments, f"{a.output}/comments")
        IO.write_table(chunks, f"{a.output}/chunks")
    elif a.cmd == "pair":
        from reverbkit.operators.pairing import tfidf_nearest_chunk

        comments = spark.read.parquet(f"{a.input}/comments")
        distinct = comments.groupBy("video_id", "comment").agg(F.min("comment_pos").alias("comment_pos"))
        chunks = spark.read.parquet(f"{a.input}/chunks")
        IO.write_table(tfidf_nearest_chunk(distinct, chunks), f"{a.output}/relevant_chunks")
    elif a.cmd == "infer":
        from reverbkit.operators.train import load_model

        scorer = flow.TextModelScorer(load_model(a.model))
        comments = spark.read.parquet(f"{a.input}/comments")
        chunks = spark.read.parquet(f"{a.input}/chunks")
        match = spark.read.parquet(f"{a.input}/relevant_chunks")
        IO.write_table(flow.predictions_from(match, comments, chunks, scorer), f"{a.output}/emotion_predictions")
    elif a.cmd == "relations":
        from reverbkit.plans.flow import relation_scores_from_predictions

        if a.format == "csv":
            # all columns are text; the confidences are cast where they are used
            preds = spark.read.option("header", True).option("multiLine", True) \
                .option("escape", '"').csv(a.input)
        else:
            preds = spark.read.parquet(a.input)
        IO.write_table(relation_scores_from_predictions(preds), a.output, fmt=a.format)
    elif a.cmd == "analyze":
        from reverbkit.operators.train import load_model

        videos = IO.read_videos(spark, a.input)
        scorer = flow.TextModelScorer(load_model(a.model))
        if a.rerun:
            flow.rerun_analysis(videos, scorer, a.output)
        else:
            flow.write_outputs(flow.run_analysis(videos, scorer), a.output)
    elif a.cmd == "train":
        from reverbkit.operators.train import save_model, train_and_evaluate

        # a unique row key (copies of one text must not share a key, or they
        # would all fall into one rank bucket); stable for a given input
        lab = IO.read_labelled(spark, a.input, a.format).withColumn("_key", F.monotonically_increasing_id())
        model, metrics = train_and_evaluate(lab, key="_key", text_col="text", label_col="label")
        save_model(model, a.output)
        metrics.show(truncate=False)


if __name__ == "__main__":
    main()
