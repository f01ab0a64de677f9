"""The multi-video flow over JSON video records, S1-S7 I/O."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from reverbkit.functions.vectors import softmax, top_k
from reverbkit.plans.flow import run_analysis
from reverbkit.sources import io as IO


class LengthScorer:
    """Deterministic stand-in for a model: logits from simple text features."""

    def score_text(self, df, text_col):
        t = F.col(text_col)
        lg = F.array(*[((F.length(t) * (i + 1)) % 7).cast("double") for i in range(6)])
        out = df.withColumn("_lg", lg).withColumn("probs", softmax("_lg")).drop("_lg")
        return out.withColumn("top3", top_k("probs", 3))


def write_videos(tmp):
    recs = [
        {"url": "u1", "title": "A", "comment_count": 213, "views": 121866, "upload_date": "13 Dec 2024",
         "tags": ["x"], "likes": 3478, "channel_name": "C", "subscriber_count": 6500000,
         "transcript": "[Music] " + " ".join(f"word{i}" for i in range(120)) + "\nend",
         "comments": ["great word5 word6 \U0001F525", "@reply ignored", "u r gr8", "great word5 word6 \U0001F525", "word100 lol"]},
        {"url": "u2", "title": None, "views": None, "transcript": "", "comments": ["hello"]},
        {"url": "u3", "transcript": "some words here", "comments": ["@only a reply"]},
    ]
    for i, r in enumerate(recs):
        with open(os.path.join(tmp, f"v{i}.json"), "w", encoding="utf-8") as f:
            json.dump(r, f, ensure_ascii=False, indent=2)
    with open(os.path.join(tmp, "bad.json"), "w") as f:
        f.write("{not json")


def test_run_analysis(spark):
    tmp = tempfile.mkdtemp(prefix="reverbkit-videos-")
    write_videos(tmp)
    videos = IO.read_videos(spark, tmp)
    good = videos.where(F.col("_corrupt_record").isNull())
    bad = videos.select("url", "transcript", "_corrupt_record").where(F.col("_corrupt_record").isNotNull()).collect()
    assert len(bad) == 1 and bad[0].url is None
    out = run_analysis(good, LengthScorer())
    urls = {r.video_id: r.url for r in good.select("video_id", "url").collect()}
    rej = {urls[r.video_id]: r.reason for r in out["rejected_videos"].collect()}
    assert rej == {"u2": "no_transcript", "u3": "no_comments"}
    preds = out["emotion_predictions"].collect()
    # duplicates collapse, reply dropped: 3 distinct comments of video u1
    assert len(preds) == 3
    rel = out["relation_scores"].collect()
    assert len(rel) == 3 and all(r.final_emotion for r in rel)
    assert sum(r.n for r in out["sentiment_distribution"].collect()) == 3
    m = {urls[r.video_id]: r for r in out["engagement_metrics"].collect()}
    assert m["u1"].likes_to_views_perc == 2.85 and m["u2"].likes_to_views_perc == 0.0
    op = {urls[r.video_id]: r for r in out["overall_opinion"].collect()}
    assert op["u3"].overall_sentiment == "N/A"
    # only the materialising job holds the search: the outputs read its table
    for name in ("relevant_chunks", "emotion_predictions", "relation_scores", "comment_report",
                 "sentiment_distribution", "emotion_distribution"):
        plan = out[name]._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Generate" not in plan and "relations-" in plan, name
    everything = run_analysis(videos, LengthScorer())["rejected_videos"]
    assert sorted(r.reason for r in everything.collect()) == ["corrupt_record", "no_comments", "no_transcript"]
    chunks = out["chunks"].where(F.col("video_id") == [k for k, v in urls.items() if v == "u1"][0]).count()
    assert chunks == 3  # 122 cleaned words -> ceil(122 / 48)

    from reverbkit.plans.flow import reference_layout, write_reference_csv

    lay = reference_layout(out)
    assert lay["relevant_chunks"].columns == ["video_id", "Comment", "Most Relevant Transcript Chunk"]
    assert lay["dependent_emotion_classification"].columns[:5] == ["video_id", "row_index", "final_emotion", "WRS", "ECF"]
    root = tempfile.mkdtemp(prefix="reverbkit-refcsv-")
    write_reference_csv(out, root)
    back = spark.read.option("header", True).csv(root + "/emotion_predictions")
    assert back.count() == 3 and "comment_conf1" in back.columns


def test_require_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(IO.MissingColumns):
        IO.require_columns(df, ["a", "comment_emotion1"])


def test_csv_round_trip_keeps_null_words(spark):
    tmp = tempfile.mkdtemp(prefix="reverbkit-csv-")
    df = spark.createDataFrame([("null", 1), ("nan", 2), ('multi\nline "q"', 3)], "text string, label int")
    IO.write_table(df, tmp + "/t", fmt="csv")
    back = IO.read_labelled(spark, tmp + "/t", fmt="csv")
    assert sorted(back.collect(), key=lambda r: r.label) == sorted(df.collect(), key=lambda r: r.label)


def test_relations_from_prediction_table(spark):
    """C5 over the flattened layout, checked against golden row 9."""
    from reverbkit.plans.flow import relation_scores_from_predictions

    row = ("c9", "Anger", "Joy", "Fear", 0.3437892198562622, 0.3080507218837738, 0.19662483036518097,
           "Joy", "Anger", "Sadness", 0.6887583136558533, 0.18926598131656647, 0.09546001255512238)
    cols = ["comment", "comment_emotion1", "comment_emotion2", "comment_emotion3", "comment_conf1", "comment_conf2",
            "comment_conf3", "transcript_emotion1", "transcript_emotion2", "transcript_emotion3",
            "transcript_conf1", "transcript_conf2", "transcript_conf3"]
    df = spark.createDataFrame([row], cols)
    r = relation_scores_from_predictions(df).first()
    assert r.comment == "c9" and r.final_emotion == "Joy" and r.ECF is None
    assert r.WRS == pytest.approx(-0.031364551088821455, abs=1e-12)
    assert r.Joy == pytest.approx(0.5573833771049976, abs=1e-12) and r.Love is None
    with pytest.raises(IO.MissingColumns):
        relation_scores_from_predictions(df.drop("transcript_conf3"))


def test_cli_stages(spark, tmp_path):
    """clean -> pair -> infer -> relations through the command line."""
    from reverbkit.__main__ import main
    from reverbkit.operators.train import build_pipeline, save_model

    vids = tmp_path / "videos"
    vids.mkdir()
    write_videos(str(vids))
    main(["clean", "--input", str(vids), "--output", str(tmp_path / "s1")])
    main(["pair", "--input", str(tmp_path / "s1"), "--output", str(tmp_path / "s1")])
    lab = spark.createDataFrame([(f"text {i} " + ("great" if i % 2 else "awful"), i % 6) for i in range(60)],
                                "text string, label int")
    model = build_pipeline(max_iter=5).fit(lab)
    save_model(model, str(tmp_path / "model"))
    main(["infer", "--input", str(tmp_path / "s1"), "--output", str(tmp_path / "s1"), "--model", str(tmp_path / "model")])
    main(["relations", "--input", str(tmp_path / "s1" / "emotion_predictions"), "--output", str(tmp_path / "rel")])
    rel = spark.read.parquet(str(tmp_path / "rel"))
    assert rel.count() == 3 and {"final_emotion", "WRS", "ECF", "Joy"} <= set(rel.columns)


def test_video_json_round_trip(spark, tmp_path):
    """S1 + S2: records written as JSON (non-ASCII kept) read back with the explicit schema."""
    src = tmp_path / "in"
    src.mkdir()
    write_videos(str(src))
    videos = IO.read_videos(spark, str(src)).where(F.col("url").isNotNull())
    IO.write_videos(videos, str(tmp_path / "out"))
    back = IO.read_videos(spark, str(tmp_path / "out")).where(F.col("url").isNotNull())
    cols = ["url", "title", "views", "comments", "transcript"]
    a = sorted((tuple(r) for r in videos.select(*cols).collect()), key=str)
    b = sorted((tuple(r) for r in back.select(*cols).collect()), key=str)
    assert a == b and len(a) == 3
    raw = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "out").glob("*.json"))
    assert "\U0001F525" in raw  # written unescaped
