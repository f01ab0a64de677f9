"""M6 / M7: the optimizer against plain numpy, metrics, sparse features, odd rows."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from reverbkit.operators import minibatch as mb


def dense(rows, dims):
    x = np.zeros((len(rows), dims + 1))
    for i, (idx, val) in enumerate(rows):
        x[i, list(idx)] = list(val)
    x[:, dims] = 1
    return x


def plain(x, y, w, part, classes, s):
    """AdamW in numpy over the same batches: (weights, train losses per epoch)."""
    weights, m, v, step, losses = np.zeros((classes, x.shape[1])), 0.0, 0.0, 0, []
    kept = []
    for epoch in range(1, s.epochs + 1):
        got = []
        for b in sorted(range(s.batches), key=lambda k: hashlib.md5(f"{s.seed}-{epoch}-{k}".encode()).hexdigest()):
            at = np.flatnonzero(part == b)
            z = x[at] @ weights.T
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            g = np.zeros_like(weights)
            step += 1
            if len(at):
                got.append(-(np.log(p[np.arange(len(at)), y[at]]) * w[at]).sum() / w[at].sum())
                p[np.arange(len(at)), y[at]] -= 1
                g = (p * w[at][:, None]).T @ x[at] / w[at].sum()
            m, v = s.beta1 * m + (1 - s.beta1) * g, s.beta2 * v + (1 - s.beta2) * g * g
            weights = weights - s.rate * (m / (1 - s.beta1**step) / (np.sqrt(v / (1 - s.beta2**step)) + s.eps) + s.decay * weights)
        losses.append(np.mean(got))
        kept.append(weights)
    return kept, losses


def make(spark, n=240, dims=12, classes=3, seed=1):
    r = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        label = int(r.integers(classes))
        idx = sorted(r.choice(dims, size=int(r.integers(0, 6)), replace=False).tolist())
        val = [float(r.normal() + (2 if k % classes == label else 0)) for k in idx]
        rows.append((i, label, ["train", "train", "val", "test"][i % 4], (idx, val)))
    df = spark.createDataFrame(rows, f"id long, label int, split string, features {mb.FEATURES}").withColumn("weight", F.lit("clash"))
    return rows, df


@pytest.mark.parametrize(("weights", "chunk"), [(None, 1 << 16), ({0: 0.5, 1: 3.0}, 5)])
def test_same_as_numpy(spark, monkeypatch, weights, chunk):
    monkeypatch.setattr(mb, "CHUNK", chunk)
    s = mb.Settings(epochs=4, batches=3, rate=0.2)
    rows, df = make(spark)
    told = None if weights is None else spark.createDataFrame(list(weights.items()), "label int, weight double")
    model, predictions = mb.train(df.repartition(7), "id", 3, 12, s, told)
    x, y, split = dense([r[3] for r in rows], 12), np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    w = np.array([(weights or {}).get(r[1], 1.0) for r in rows])
    part = np.array([int(hashlib.md5(f"batch{s.seed}{r[0]}".encode()).hexdigest()[:8], 16) % s.batches if r[2] == "train" else -1 for r in rows])
    kept, losses = plain(x, y, w, part, 3, s)
    val = [h for h in model.history if h["split"] == "val"]
    assert np.allclose([h["train_loss"] for h in val], losses)

    def scored(weights, name):
        at = split == name
        z = x[at] @ weights.T
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        return p, -np.log(p[np.arange(at.sum()), y[at]]).mean(), (p.argmax(axis=1) == y[at]).mean()

    assert np.allclose([h["loss"] for h in val], [scored(k, "val")[1] for k in kept])
    assert np.allclose([h["accuracy"] for h in val], [scored(k, "val")[2] for k in kept])
    best = min(range(4), key=lambda e: (val[e]["loss"], e))
    assert np.allclose(model.weights, kept[best])
    test = model.history[-1]
    assert test["split"] == "test" and test["epoch"] == best + 1
    got = {r["id"]: r["probs"] for r in predictions.collect()}
    assert np.allclose([got[r[0]] for r in rows if r[2] == "test"], scored(kept[best], "test")[0])
    assert test["accuracy"] > test["majority"]


def test_does_not_depend_on_the_partitions(spark):
    _, df = make(spark)
    s = mb.Settings(epochs=2, batches=2)
    a, b = (mb.train(df.repartition(k), "id", 3, 12, s)[0].weights for k in (1, 11))
    assert np.allclose(a, b, rtol=0, atol=1e-12)


def test_metrics_match_definitions(spark):
    pairs = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 4 + [(1, 2)] * 3 + [(2, 0)]
    got = mb.evaluate(spark.createDataFrame([(a, b, 0.5) for a, b in pairs], "label int, pred int, loss double"))
    support, predicted = Counter(a for a, _ in pairs), Counter(b for _, b in pairs)
    tp = Counter(a for a, b in pairs if a == b)
    p = {k: tp[k] / predicted[k] for k in support}
    r = {k: tp[k] / support[k] for k in support}
    f = {k: 2 * p[k] * r[k] / (p[k] + r[k]) if p[k] + r[k] else 0 for k in support}
    assert got["n"] == 15 and math.isclose(got["accuracy"], 9 / 15) and math.isclose(got["loss"], 0.5)
    for name, x in (("precision", p), ("recall", r), ("f1", f)):
        assert math.isclose(got[name], sum(support[k] * x[k] for k in support) / 15)
    assert math.isclose(got["majority"], 7 / 15)


def test_text_features(spark):
    texts = {1: "Hello hello WORLD ***", 2: "hello !!", 3: "", 4: None, 5: "ÉTÉ été x"}
    df = spark.createDataFrame([(k, t, "clash") for k, t in texts.items()], "id long, text string, idx string")
    dims, fitted = 97, {1, 2, 5}
    out = {r["id"]: dict(zip(r["features"]["idx"], r["features"]["val"], strict=True)) for r in mb.text_features(df, "id", "text", dims, df.where(F.col("id").isin(1, 2, 5))).collect()}
    place = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:6], 16) % dims
    counts = {}
    for k, t in texts.items():
        terms = []
        for x in re.findall(r"[^\W_]+|(?:[^\w\s]|_)+", t or ""):
            terms += [x.lower(), *(["<caps>"] if len(x) > 1 and x.isupper() and x.isalpha() else [])]
        counts[k] = Counter(map(place, terms))
    assert out[3] == out[4] == {}
    for k in (1, 2, 5):
        idf = {i: math.log((1 + 3) / (1 + sum(i in counts[x] for x in fitted))) + 1 for i in counts[k]}
        want = {i: (1 + math.log(n)) * idf[i] for i, n in counts[k].items()}
        norm = math.sqrt(sum(x * x for x in want.values()))
        assert out[k].keys() == want.keys()
        assert all(math.isclose(out[k][i], want[i] / norm) for i in want)


def test_odd_rows_and_empty_splits(spark):
    rows = [(1, 0, "train", ([], [])), (2, 1, "train", ([0], [1.0])), (3, None, "train", ([0], [1.0])), (4, 7, "val", ([0], [1.0])), (5, 1, "test", ([0], [1.0]))]
    df = spark.createDataFrame(rows, f"id long, label int, split string, features {mb.FEATURES}")
    model, predictions = mb.train(df, "id", 2, 1, mb.Settings(epochs=2, batches=5))
    assert [h["n"] for h in model.history] == [0, 0, 1] and model.history[-1]["epoch"] == 1
    assert [r["id"] for r in predictions.collect()] == [5]
    none, told = mb.train(df.limit(0), "id", 2, 1, mb.Settings(epochs=1, batches=2))
    assert none.history[0]["train_loss"] is None and told.count() == 0
    assert mb.history(none, spark).count() == 2
    assert spark.createDataFrame([([],), ([1.0, 2.0],)], "vec array<double>").select(mb.vector_features().alias("f")).collect()[1]["f"]["idx"] == [0, 1]


def test_quality_of_texts_is_learned(spark):
    """Documents told apart well above the share of the larger class."""
    from reverbkit.plans.training_queries import train_quality

    model, _ = train_quality(spark, "/root/testdata/sf0.01")
    test = model.history[-1]
    assert test["accuracy"] > test["majority"] + 0.05
    assert [h["split"] for h in model.history] == ["val"] * 5 + ["test"]


def test_saved_and_loaded(spark, tmp_path):
    _, df = make(spark, n=60)
    model, _ = mb.train(df, "id", 3, 12, mb.Settings(epochs=2, batches=2))
    mb.save(model, spark, str(tmp_path / "m"))
    again = mb.load(spark, str(tmp_path / "m"))
    assert np.array_equal(again.weights, model.weights) and again.history == model.history
