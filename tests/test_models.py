"""Model extension points: iterator pandas UDFs loaded once per task."""

import numpy as np
from pyspark.sql import functions as F

from reverbkit.operators.models import PandasModelScorer, model_vectoriser, score_summaries
from reverbkit.operators.pairing import nearest_chunk


def make_loaders():
    # defined inside a function so cloudpickle ships them by value to workers
    import zlib

    def load_encoder():
        def encode(texts):
            out = np.zeros((len(texts), 16))
            for i, t in enumerate(texts):
                for w in t.split():
                    out[i, zlib.crc32(w.encode()) % 16] += 1.0
            return out
        return encode

    def load_classifier():
        def predict(texts):
            return np.array([[len(t) % (k + 2) for k in range(6)] for t in texts], dtype=float)
        return predict

    return load_encoder, load_classifier


def test_vectoriser_feeds_nearest_chunk(spark):
    load_encoder, _ = make_loaders()
    vec = model_vectoriser(load_encoder)
    comments = spark.createDataFrame([(1, 1, "red apple"), (1, 2, "blue sky")], "video_id long, comment_id long, t string")
    chunks = spark.createDataFrame([(1, 1, "a blue sky today"), (1, 2, "the red apple tree")],
                                   "video_id long, chunk_index int, t string")
    got = {r.comment_id: r.chunk_index for r in nearest_chunk(vec(comments, "t"), vec(chunks, "t")).collect()}
    assert got == {1: 2, 2: 1}


def test_scorer_and_summaries(spark):
    s = spark.createDataFrame([("a short summary",), ("another, somewhat longer summary text",)], "summary string")
    _, load_classifier = make_loaders()
    out = score_summaries(PandasModelScorer(load_classifier), s).collect()
    assert len(out) == 2
    for r in out:
        assert r.summary_conf1 >= r.summary_conf2 >= r.summary_conf3
        assert r.summary_emotion1 in {"Sadness", "Joy", "Love", "Anger", "Fear", "Surprise"}
