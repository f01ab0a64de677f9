"""Extracts against a walk over all pairs of sentences."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reverbkit.operators import summaries
from reverbkit.operators.summaries import DAMPING, ROUNDS, sentence_ranks, sentences, summarise, term_weights


def brute(rows):
    """Ranks of (video, segment, text) rows by the written matrix of each video."""
    out = {}
    for video in {v for v, _, _ in rows}:
        vec = {}
        for _, seg, text in sorted(r for r in rows if r[0] == video):
            for pos, s in enumerate(re.split(r"[.!?\n]+", text or "")):
                n = Counter(t for t in re.split(r'[ \t\r\n,;:()"]+', s.lower()) if t)
                norm = math.sqrt(sum(c * c for c in n.values()))
                if n:
                    vec[seg, pos] = {t: c / norm for t, c in n.items()}
        edge = {(a, b): sum(w * vec[b].get(t, 0) for t, w in vec[a].items()) for a in vec for b in vec if a != b}
        degree = {a: sum(edge[a, b] for b in vec if b != a) for a in vec}
        rank = dict.fromkeys(vec, 1.0)
        for _ in range(ROUNDS):
            rank = {a: 1 - DAMPING + DAMPING * sum(edge[a, b] * rank[b] / degree[b] for b in vec if edge.get((a, b))) for a in vec}
        out |= {(video, *a): r for a, r in rank.items()}
    return out


ROWS = [
    (1, 0, "The cat sat. A dog sat on the cat! Nothing\nthe end, the end"),
    (1, 1, "cat and dog; cat and dog. zebra"),
    (2, 0, "one. one. one"),
    (3, 0, ""), (3, 1, None), (4, 0, " . ,, !"),
    (5, 0, "alone"),
    (6, 0, "a b. " * 40 + "b c. c d"),
    (7, 0, "word " * 3000 + ". word again"),
]


def test_ranks_equal_the_walk_over_pairs(spark):
    df = spark.createDataFrame(ROWS, "video_id long, seg_idx long, segment string").withColumn("term", F.lit("clash")).withColumn("rank", F.lit(1))
    got = {(r.video_id, r.seg, r.pos): r["rank"] for r in sentence_ranks(term_weights(sentences(df))).collect()}
    want = brute(ROWS)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


@pytest.mark.parametrize("group_rows", [0, 6])
def test_large_videos_walk_by_joins(spark, group_rows):
    df = spark.createDataFrame(ROWS, "video_id long, seg_idx long, segment string")
    got = {(r.video_id, r.seg, r.pos): r["rank"] for r in sentence_ranks(term_weights(sentences(df)), group_rows=group_rows).collect()}
    want = brute(ROWS)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_bounded_videos_write_no_rounds(spark, monkeypatch):
    """Rounds of small videos neither shuffle the weights again nor write ranks."""
    written, cut = [], summaries.cut_lineage
    monkeypatch.setattr(summaries, "cut_lineage", lambda df, name: written.append(name) or cut(df, name))
    df = spark.createDataFrame(ROWS, "video_id long, seg_idx long, segment string")
    assert summarise(df, rounds=5).count() == 5
    assert sorted(written) == ["large", "ranks", "weights"]


def test_extracts(spark):
    df = spark.createDataFrame(ROWS, "video_id long, seg_idx long, segment string")
    got = {r.video_id: r for r in summarise(df).collect()}
    assert set(got) == {1, 2, 5, 6, 7}
    # equal ranks: the earlier ones
    assert got[2].summary == "one. one. one." and got[5].summary == "alone." and got[6].n_sentences == 42
    ranks = {k[1:]: r for k, r in brute(ROWS).items() if k[0] == 1}
    text = {(s, p): t.strip() for v, s, x in ROWS if v == 1 for p, t in enumerate(re.split(r"[.!?\n]+", x))}
    best = sorted(sorted(ranks, key=lambda k: (-round(ranks[k], 9), k))[:3])
    assert got[1].summary == ". ".join(text[k] for k in best) + "."


def test_empty_and_repeated(spark):
    empty = spark.createDataFrame([], "video_id long, seg_idx long, segment string")
    assert summarise(empty).collect() == []
    twice = spark.createDataFrame([(1, 0, "b a. c"), (1, 0, "a a. c"), (None, 0, "x")], "video_id long, seg_idx long, segment string")
    got = [r for r in summarise(twice).collect() if r.video_id == 1]
    assert [(r.n_sentences, r.summary) for r in got] == [(2, "a a. c.")]


def test_no_pairs_in_the_plan(spark):
    df = spark.createDataFrame(ROWS, "video_id long, seg_idx long, segment string")
    w = term_weights(sentences(df))
    plan = sentence_ranks(w, rounds=0)._jdf.queryExecution().toString() + w._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
