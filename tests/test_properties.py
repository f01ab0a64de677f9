"""Property tests (hypothesis) for CES bounds and chunk coverage."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reverbkit.constants import EMOTIONS
from reverbkit.functions import relations as R
from reverbkit.functions.vectors import softmax, top_k

logits = st.lists(st.floats(min_value=-20, max_value=20, allow_nan=False), min_size=6, max_size=6)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(logits, logits), min_size=1, max_size=20))
def test_ces_bounds_and_final(spark, rows):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "i int, a array<double>, b array<double>")
    df = df.withColumn("pa", softmax("a")).withColumn("pb", softmax("b"))
    df = df.withColumn("ct", top_k("pa")).withColumn("tt", top_k("pb"))
    df = df.withColumn("ces", R.ces_array("ct", "tt"))
    df = df.withColumn("final", R.final_emotion("ct", "ces"))
    for r in df.collect():
        confs = [c.conf for c in r.ct]
        assert confs == sorted(confs, reverse=True)
        tsum = sum(t.conf for t in r.tt)
        for c, v in zip(r.ct, r.ces):
            # |M| <= 1, so the context term is bounded by lambda * sum(transcript confs)
            assert c.conf - 0.5 * tsum - 1e-12 <= v <= c.conf + 0.5 * tsum + 1e-12
        best = max(range(3), key=lambda i: (r.ces[i], -i))
        assert r.final == r.ct[best].emotion and r.final in EMOTIONS


@settings(max_examples=20, deadline=None)
@given(st.integers(min_value=0, max_value=400), st.integers(min_value=2, max_value=70), st.data())
def test_chunks_cover_text(spark, n, size, data):
    from reverbkit.operators.chunks import chunk_text

    overlap = data.draw(st.integers(min_value=0, max_value=size - 1))
    step = size - overlap
    text = " ".join(f"w{i}" for i in range(n))
    df = spark.createDataFrame([(1, text)], "video_id long, t string")
    chunks = [r.chunk.split() for r in chunk_text(df, "video_id", "t", size, overlap).orderBy("chunk_index").collect()]
    assert len(chunks) == (n + step - 1) // step
    # dropping the overlaps re-joins to the text
    rebuilt = []
    for c in chunks:
        rebuilt.extend(c[: step] if len(c) > step else c)
    assert rebuilt[:n] == text.split()
