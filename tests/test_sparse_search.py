"""TF-IDF search: groups of bounded videos, joins for the others."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from reverbkit.operators import pairing
from reverbkit.operators.pairing import tfidf_nearest_chunk


def make(spark):
    rng = random.Random(4)
    vocab = ["Ab", "éa", "b1", "c", "d", "İx", "g", "ß", "h2", "k"]

    def text(n):
        return rng.choice([" ", ", "]).join(rng.choice(vocab) for _ in range(n))

    comments, chunks = [], []
    for video in range(30):
        chunks += [(video, k, text(rng.randint(0, 9)), f"k{video}-{k}") for k in range(1, rng.choice([2, 3, 9, 20]))]
        chunks += [(video, 100 + k, t, f"copy{video}-{k}") for v, k, t, _ in chunks if v == video and k % 3 == 0]
        comments += [(video, 2 * c, rng.choice([text(rng.randint(0, 6)), "zzz", "", None]), [f"p{c}"]) for c in range(rng.choice([1, 4, 12]))]
    comments += [(77, 1, "ab", ["no chunks"]), (None, 1, "ab", ["no video"])]
    chunks += [(88, 1, "ab", "no comments"), (None, 1, "ab", "no video"), (5, 300, None, "null")]
    rng.shuffle(chunks)
    c = spark.createDataFrame(comments, "video_id long, comment_pos long, comment string, who array<string>")
    k = spark.createDataFrame(chunks, "video_id long, chunk_index int, chunk string, name string")
    return comments, chunks, c, k


def brute(comments, chunks):
    def tf(t):
        return Counter(re.findall(r"\w+", (t or "").lower()))

    out = {}
    for video in {x[0] for x in comments} & {x[0] for x in chunks} - {None}:
        own = sorted((k, tf(t), name) for v, k, t, name in chunks if v == video)
        df = Counter(w for _, t, _ in own for w in t)
        idf = {w: math.log((1 + len(own)) / (1 + n)) for w, n in df.items() if n < len(own)}
        for v, pos, t, who in comments:
            if v != video:
                continue
            a = {w: n * idf[w] for w, n in tf(t).items() if w in idf}
            best = None
            for k, u, name in own:
                b = {w: n * idf[w] for w, n in u.items() if w in idf}
                den = math.sqrt(sum(x * x for x in a.values())) * math.sqrt(sum(x * x for x in b.values()))
                sim = sum(x * b.get(w, 0) for w, x in a.items()) / den if den else 0.0
                if best is None or round(sim, 9) > round(best[1], 9):
                    best = k, sim, name, tuple(who)
            out[v, pos] = best
    return out


def rows(df):
    found = df.collect()
    out = {(r["video_id"], r["comment_pos"]): (r["chunk_index"], round(r["similarity"], 9), r["name"], tuple(r["who"])) for r in found}
    assert len(out) == len(found)
    return out


def test_groups_equal_joins_and_brute_force(spark, monkeypatch):
    comments, chunks, c, k = make(spark)
    # a dotted capital I lower-cases to a letter and a mark, which ends the term
    want = {x: (i, round(s, 9), name, who) for x, (i, s, name, who) in brute(
        [(v, p, (t or "").replace("İx", "i x"), w) for v, p, t, w in comments], [(v, p, (t or "").replace("İx", "i x"), n) for v, p, t, n in chunks]).items()}
    carried = {"comment_payload": ["who"], "chunk_payload": ["name"]}
    assert rows(tfidf_nearest_chunk(c, k, **carried)) == want
    for size in (0, 700):
        assert rows(tfidf_nearest_chunk(c, k, group_size=size, block_size=4, rows_per_salt=5, **carried)) == want
    monkeypatch.setattr(pairing, "MET", 3)
    monkeypatch.setattr(pairing, "BUNDLE_SIZE", 900)
    assert rows(tfidf_nearest_chunk(c, k, **carried)) == want


def test_rows_without_a_key_of_their_own(spark):
    _, _, c, k = make(spark)
    odd = spark.createDataFrame([(3, 0, "c d", ["again"]), (4, None, "c d", ["none"])], c.schema)
    c = c.where("comment_pos > 0 or video_id != 3").unionByName(odd).unionByName(odd)
    got = [sorted((r["video_id"], r["comment_pos"] or -1, r["chunk_index"], round(r["similarity"], 9)) for r in tfidf_nearest_chunk(c, k, group_size=n).collect()) for n in (0, 10**6)]
    assert got[0] == got[1]


def test_bounded_videos_need_no_term_table(spark):
    _, _, c, k = make(spark)
    plan = tfidf_nearest_chunk(c, k)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Join" not in plan and "idf-" not in plan


def test_comments_are_cleaned_once(spark):
    """No filter below the projections repeats the cleaning."""
    from reverbkit.functions.text import with_clean_comment
    from reverbkit.plans.text_queries import cleaned_comments, raw_comments

    def steps(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all")

    df = cleaned_comments(spark, "/root/testdata/sf0.001")
    every = with_clean_comment(raw_comments(spark, "/root/testdata/sf0.001"), "raw_comment").select(df.columns)
    assert 0 < steps(df) == steps(every)
    assert sorted(df.collect()) == sorted(every.where(F.col("comment").isNotNull()).collect()) and df.count() > 0
