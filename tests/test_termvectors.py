"""M5: co-occurrence vectors against numpy, text vectors, odd texts."""

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from reverbkit.operators import termvectors as tv

TOPICS = ["cat dog bird fish mouse", "road car wheel engine fuel", "sea wave sand shell tide"]


def corpus(seed=2, n=200):
    r = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        words = TOPICS[r.integers(3)].split() + ["the", "a"]
        out.append(" ".join(r.choice(words, size=r.integers(2, 20))))
    return [*out, None, "", "Once!", "CAT dog, dog cat"]


def matrix(texts, window, min_count):
    words = [re.findall(r"[^\W_]+", (t or "").lower()) for t in texts]
    n = Counter(w for ws in words for w in ws)
    names = sorted(w for w in n if n[w] >= min_count)
    at = {w: i for i, w in enumerate(names)}
    c = np.zeros((len(names), len(names)))
    for ws in words:
        ws = [at[w] for w in ws if w in at]
        for p in range(len(ws)):
            for o in range(1, window + 1):
                if p + o < len(ws):
                    c[ws[p], ws[p + o]] += 1
                    c[ws[p + o], ws[p]] += 1
    s = c.sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        return names, np.nan_to_num(np.maximum(np.log(c * c.sum() / np.outer(s, s)), 0), neginf=0, posinf=0)


def test_pairs_match_definition(spark):
    texts = corpus()
    names, want = matrix(texts, 3, 2)
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(5)
    got = np.zeros_like(want)
    for r in tv.term_pairs(df, "t", window=3, min_count=2).collect():
        got[names.index(r["a"]), names.index(r["b"])] = r["ppmi"]
    assert np.allclose(got, want)


def test_vectors_are_the_leading_part_of_the_matrix(spark):
    texts, dims = corpus(), 3
    names, m = matrix(texts, 4, 2)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    vectors, values = tv.learn(df, "t", dims=dims, rounds=12)
    own, axes = np.linalg.eigh(m)
    top = np.argsort(-np.abs(own))[:dims]
    assert np.allclose(np.sort(values), np.sort(own[top]), rtol=1e-4)
    best = (axes[:, top] * np.maximum(own[top], 0)) @ axes[:, top].T
    x = np.zeros((len(names), dims))
    for r in vectors.collect():
        x[names.index(r["term"])] = r["vec"]
    assert np.allclose(x @ x.T, best, atol=1e-3)
    # words of a topic stand nearer each other than those of different ones
    of = {r["term"]: np.array(r["vec"]) for r in vectors.collect()}
    cos = lambda a, b: of[a] @ of[b] / (np.linalg.norm(of[a]) * np.linalg.norm(of[b]))
    assert min(cos("cat", "dog"), cos("wave", "sand")) > 0.5 > max(cos("cat", "wave"), cos("dog", "wheel"))


def test_the_partitions_do_not_matter(spark):
    df = spark.createDataFrame([(t,) for t in corpus()], "t string")
    a, b = ({r["term"]: r["vec"] for r in tv.learn(df.repartition(k), "t", dims=3, rounds=12)[0].collect()} for k in (1, 7))
    assert a.keys() == b.keys()
    assert all(np.allclose(np.abs(a[t]), np.abs(b[t]), atol=1e-6) for t in a)


def test_text_vectors(spark):
    rows = [(1, "Cat cat dog"), (2, "unknown"), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "id long, t string").withColumn("vec", F.lit("clash")).drop("vec")
    vectors = spark.createDataFrame([("cat", [1.0, 0.0]), ("dog", [0.0, 2.0])], "term string, vec array<double>")
    idf = spark.createDataFrame([("cat", 0.5), ("dog", 3.0)], "term string, idf double")
    got = {r["id"]: r["vec"] for r in tv.text_vectors(df, ["id"], "t", vectors, idf, 2).collect()}
    assert got == {1: [1.0, 6.0], 2: [0.0, 0.0], 3: [0.0, 0.0], 4: [0.0, 0.0]}
    known = {r["term"]: r["idf"] for r in tv.inverse_frequency(df, "t").collect()}
    assert math.isclose(known["cat"], math.log(5 / 2)) and known.keys() == {"cat", "dog", "unknown"}


def test_few_terms_and_none(spark):
    df = spark.createDataFrame([("x y",), ("x y x",)], "t string")
    vectors, values = tv.learn(df, "t", dims=4, rounds=2)
    assert {r["term"] for r in vectors.collect()} == {"x", "y"} and len(values) == 4
    none, _ = tv.learn(df.limit(0), "t", dims=4, rounds=2)
    assert none.collect() == []


def test_search_equals_brute_force_on_the_written_vectors(spark):
    from reverbkit.plans.text_queries import TEXT_DIMS, learned_texts, nearest_chunk

    comments, chunks, vectors, idf = learned_texts(spark, "/root/testdata/sf0.01")
    c = tv.text_vectors(comments, ["video_id", "comment_pos"], "comment", vectors, idf, TEXT_DIMS)
    k = tv.text_vectors(chunks, ["video_id", "chunk_index"], "chunk", vectors, idf, TEXT_DIMS)
    of = {}
    for r in k.collect():
        of.setdefault(r["video_id"], []).append((r["chunk_index"], np.array(r["vec"])))
    asked = {(r["video_id"], r["comment_pos"]): np.array(r["vec"]) for r in c.collect()}
    found = {(r["video_id"], r["comment_pos"]): r for r in nearest_chunk(c, k, comment_key="comment_pos", block_size=2).collect()}
    assert found.keys() == {x for x in asked if x[0] in of}
    right = 0
    for key, r in found.items():
        v = asked[key]
        sims = {i: (v @ w / d if (d := np.linalg.norm(v) * np.linalg.norm(w)) > 0 else 0.0) for i, w in of[key[0]]}
        best = max(sims.values())
        right += abs(sims[r["chunk_index"]] - best) < 1e-9
        assert abs(r["similarity"] - sims[r["chunk_index"]]) < 1e-9
    assert right == len(found)  # recall 1.00: the search is exact


def test_the_matrix_is_kept_by_one_half_and_cut_into_cells(spark, monkeypatch):
    texts = corpus() + ["the the the cat"]
    names, m = matrix(texts, 4, 2)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    written, cut = {}, tv.cut_lineage
    monkeypatch.setattr(tv, "cut_lineage", lambda d, name="t": written.setdefault(name, cut(d, name)) if name == "cells" else cut(d, name))
    whole, values = tv.learn(df, "t", dims=3, rounds=12)
    # every pair once, in arrays; not a row for each pair in both orders
    rows = written.pop("cells").select(F.size("c").alias("n")).collect()
    assert len(rows) == 1 and rows[0]["n"] == (np.triu(m) > 0).sum()
    monkeypatch.setattr(tv, "CELL", 12)
    monkeypatch.setattr(tv, "SLICE", 5)
    cells, again = tv.learn(df, "t", dims=3, rounds=12)
    rows = written["cells"].select("pa", "pb", F.size("c").alias("n")).collect()
    assert sum(r["n"] for r in rows) == (np.triu(m) > 0).sum() and len({(r["pa"], r["pb"]) for r in rows}) > 3
    assert max(r["n"] for r in rows) <= 5 and all(r["pa"] <= r["pb"] for r in rows)
    assert np.allclose(values, again)
    a, b = ({r["term"]: np.array(r["vec"]) for r in x.collect()} for x in (whole, cells))
    assert a.keys() == b.keys() and all(np.allclose(np.abs(a[t]), np.abs(b[t]), atol=1e-6) for t in a)


def test_texts_of_several_groups(spark, monkeypatch):
    texts = [(i, t) for i, t in enumerate(corpus())]
    df = spark.createDataFrame(texts, "id long, t string")
    vectors = spark.createDataFrame([("cat", [1.0, 0.0]), ("the", [0.0, 2.0])], "term string, vec array<double>")
    idf = spark.createDataFrame([("cat", 0.5), ("the", 3.0)], "term string, idf double")
    monkeypatch.setattr(tv, "GROUP", 500)
    got = {r["id"]: r["vec"] for r in tv.text_vectors(df, ["id"], "t", vectors, idf, 2).collect()}
    words = {i: Counter((t or "").lower().split()) for i, t in texts}
    assert got.keys() == words.keys()
    assert all(np.allclose(got[i], [0.5 * w["cat"], 6.0 * w["the"]]) for i, w in words.items() if i < 200)
