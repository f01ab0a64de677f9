"""M1, M2, A3, A14 and the exact two-level rank."""

import hashlib
import random

from pyspark.sql import functions as F

from reverbkit.operators import prep as P


def brute_rank(rows, seed):
    by = {}
    for key, label in rows:
        by.setdefault(label, []).append(key)
    out = {}
    for label, keys in by.items():
        keys.sort(key=lambda k: (hashlib.md5(f"{seed}{k}".encode()).hexdigest(), k))
        for i, k in enumerate(keys):
            out[k] = (i + 1, len(keys))
    return out


def fixture(spark, n=3000, labels=6, skew=True):
    rnd = random.Random(3)
    rows = []
    for k in range(n):
        # one label holds about a third of all rows
        lab = 0 if (skew and rnd.random() < 0.34) else rnd.randrange(labels)
        rows.append((k, lab))
    return rows, spark.createDataFrame(rows, "key long, label int")


def test_rank_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(P, "BUCKET_HEX", 2)
    rows, df = fixture(spark)
    want = brute_rank(rows, 42)
    got = {r.key: (r.rank, r.n_label) for r in P.rank_within_label(df, "label", "key", 42, bucket_hex=2).collect()}
    assert got == want


def test_undersample_exact(spark):
    rows, df = fixture(spark)
    out = P.undersample(df, "label", "key").collect()
    counts = {}
    for r in out:
        counts[r.label] = counts.get(r.label, 0) + 1
    smallest = min(sum(1 for _, lab in rows if lab == x) for x in set(lab for _, lab in rows))
    assert set(counts.values()) == {smallest}
    want = brute_rank(rows, 42)
    assert all(want[r.key][0] <= smallest for r in out)


def test_split_disjoint_complete(spark):
    rows, df = fixture(spark)
    s = P.stratified_split(df, "label", "key").collect()
    assert sorted(r.key for r in s) == sorted(k for k, _ in rows)
    for lab in set(lab for _, lab in rows):
        n = sum(1 for _, x in rows if x == lab)
        part = [r.split for r in s if r.label == lab]
        assert part.count("train") == (n * 70) // 100
        assert part.count("train") + part.count("val") == (n * 85) // 100


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "label int")
    w = {r.label: r.weight for r in P.class_weights(df, "label").collect()}
    assert w == {0: 8 / (2 * 6), 1: 8 / (2 * 2)}


def test_label_distribution(spark):
    df = spark.createDataFrame([(0,), (0,), (5,), (7,)], "label int")
    got = {r.label: (r.emotion, r.n, r.n_labels) for r in P.label_distribution(df).collect()}
    assert got == {0: ("Sadness", 2, 3), 5: ("Surprise", 1, 3), 7: (None, 1, 3)}


def test_hash_split_no_shuffle(spark):
    _, df = fixture(spark)
    out = P.hash_split(df, "key")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    counts = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    n = sum(counts.values())
    assert abs(counts["train"] / n - 0.70) < 0.05 and abs(counts["test"] / n - 0.15) < 0.05


def test_null_labels(spark):
    """The split keeps rows without a label, as a group of their own; balancing drops them."""
    from reverbkit.operators.prep import stratified_split, undersample

    rows = [(i, None if i % 5 == 4 else i % 5) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, label int")
    split = stratified_split(df, "label", "id").groupBy("label", "split").count().collect()
    assert {(r["label"], r["split"]): r["count"] for r in split} == {
        (k, s): n for k in (0, 1, 2, 3, None) for s, n in (("train", 28), ("val", 6), ("test", 6))
    }
    assert undersample(df, "label", "id", 7).groupBy("label").count().where("count = 7").count() == 4
