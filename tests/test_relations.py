"""C1-C5, P4, P11 against the golden vectors of FIXTURES.md."""

import pytest
from pyspark.sql import functions as F

from reverbkit.constants import EMOTIONS
from reverbkit.functions import relations as R

IDX = {e: i for i, e in enumerate(EMOTIONS)}


def top3(pairs):
    return [(e, float(c), IDX[e]) for e, c in pairs]


def frame(spark, rows):
    schema = ("id int, ctop array<struct<emotion:string,conf:double,idx:int>>, "
              "ttop array<struct<emotion:string,conf:double,idx:int>>")
    df = spark.createDataFrame(rows, schema)
    df = df.withColumn("ces", R.ces_array("ctop", "ttop"))
    df = df.withColumn("wrs", R.wrs(F.col("ctop"), F.col("ttop"), F.col("ces")))
    df = df.withColumn("ecf", R.ecf(F.col("wrs"), F.col("ctop"), F.col("ttop")))
    return df.withColumn("final", R.final_emotion("ctop", "ces"))


T_SURPRISE = [("Surprise", 0.9986867308616638), ("Joy", 0.0008235558634623885), ("Love", 0.00022433769481722265)]
T_JOY = [("Joy", 0.8393650650978088), ("Anger", 0.0780581459403038), ("Sadness", 0.05519483610987663)]
GOLDEN = [
    (2, [("Anger", 0.3989095687866211), ("Sadness", 0.3423064351081848), ("Joy", 0.129587784409523)], T_SURPRISE,
     0.2292320191771546, "Anger", [0.49851626848321756, 0.44170724583891574, 0.4795960025665408]),
    (6, [("Joy", 0.9953256845474243), ("Love", 0.0012206363026052713), ("Fear", 0.0011775330640375614)], T_SURPRISE,
     1.0994131586416531, "Joy", [1.3453339027044422, 0.15134170374512892, 0.0508835468717734]),
    (9, [("Anger", 0.3437892198562622), ("Joy", 0.3080507218837738), ("Fear", 0.19662483036518097)],
     [("Joy", 0.6887583136558533), ("Anger", 0.18926598131656647), ("Sadness", 0.09546001255512238)],
     -0.031364551088821455, "Joy", [0.2900976352393627, 0.5573833771049976, 0.07669015228748313]),
    (17, [("Joy", 0.5248968601226807), ("Surprise", 0.3550487458705902), ("Fear", 0.10000967979431152)], T_JOY,
     0.7098203186059806, "Joy", [0.8974674381315708, 0.6621518168598413, -0.084324155561626]),
    (19, [("Anger", 0.5805381536483765), ("Sadness", 0.1785762757062912), ("Joy", 0.16186001896858215)], T_JOY,
     -0.11658432175295205, "Joy", [0.4235246693715453, -0.19399430230259898, 0.5344305969774723]),
]


def test_golden_rows(spark):
    rows = [(i, top3(c), top3(t)) for i, c, t, *_ in GOLDEN]
    got = {r["id"]: r for r in frame(spark, rows).collect()}
    for i, _, _, wrs, final, ces in GOLDEN:
        r = got[i]
        assert r["wrs"] == pytest.approx(wrs, abs=1e-12)
        assert r["final"] == final
        assert r["ecf"] is None
        for a, b in zip(r["ces"], ces):
            assert a == pytest.approx(b, abs=1e-12)


BRANCHES = [
    ([("Sadness", .9), ("Anger", .06), ("Fear", .04)], [("Joy", .95), ("Love", .03), ("Surprise", .02)], -0.72915, "high_sarcasm"),
    ([("Joy", .9), ("Love", .06), ("Surprise", .04)], [("Sadness", .95), ("Anger", .03), ("Fear", .02)], -0.73125, "high_irony"),
    ([("Anger", .9), ("Sadness", .06), ("Fear", .04)], [("Joy", .9), ("Love", .06), ("Surprise", .04)], -0.2058, "moderate_mismatch"),
    ([("Sadness", .65), ("Anger", .2), ("Fear", .15)], [("Joy", .99), ("Love", .006), ("Surprise", .004)], -0.59733, None),
]


def test_mismatch_branches(spark):
    rows = [(i, top3(c), top3(t)) for i, (c, t, _, _) in enumerate(BRANCHES)]
    got = {r["id"]: r for r in frame(spark, rows).collect()}
    for i, (_, _, wrs, flag) in enumerate(BRANCHES):
        assert got[i]["wrs"] == pytest.approx(wrs, abs=1e-9)
        assert got[i]["ecf"] == flag


def test_ces_for_named_columns(spark):
    rows = [(1, top3(GOLDEN[0][1]), top3(GOLDEN[0][2]))]
    df = frame(spark, rows).select(*[R.ces_for(e, "ctop", "ces").alias(e) for e in EMOTIONS])
    r = df.first().asDict()
    assert r["Love"] is None and r["Fear"] is None and r["Surprise"] is None
    assert r["Anger"] == pytest.approx(0.49851626848321756, abs=1e-12)


def test_sentiment_rule(spark):
    df = spark.createDataFrame([("Fear", 0.5), ("Fear", 0.4999), ("Surprise", 0.9), ("Anger", None)], "e string, c double")
    got = [r[0] for r in df.select(R.sentiment(F.col("e"), F.col("c"))).collect()]
    assert got == ["Negative", "Neutral", "Positive", "Negative"]


def test_bands(spark):
    from reverbkit.operators.report import engagement_bands

    m = spark.createDataFrame(
        [(1, 2.85, 0.5, 1.87), (2, 0.5, 0.51, 25.0), (3, 6.0, 0.49, 15.0)],
        "video_id long, likes_to_views_perc double, comments_to_views_perc double, views_to_subs_perc double",
    )
    got = {(r.video_id, r.metric): r.band for r in engagement_bands(m).collect()}
    assert got[(1, "likes_to_views_perc")] == "good"
    assert got[(1, "comments_to_views_perc")] == "good"
    assert got[(2, "comments_to_views_perc")] == "over"
    assert got[(3, "comments_to_views_perc")] == "under"
    assert got[(1, "views_to_subs_perc")] == "under"
    assert got[(2, "views_to_subs_perc")] == "over"
    assert got[(3, "likes_to_views_perc")] == "over"


def test_ratio_sample(spark):
    from reverbkit.operators.report import engagement_metrics

    c = spark.createDataFrame([(1, 121866, 3478, 213, 6500000), (2, 0, 5, None, 0)],
                              "video_id long, views long, likes long, comment_count long, subscriber_count long")
    r = {x.video_id: x for x in engagement_metrics(c).collect()}
    assert (r[1].likes_to_views_perc, r[1].comments_to_views_perc, r[1].views_to_subs_perc) == (2.85, 0.17, 1.87)
    assert (r[2].likes_to_views_perc, r[2].views_to_subs_perc) == (0.0, 0.0)
