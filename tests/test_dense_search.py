"""Blocked products and block bounds of the dense search."""

import time

import numpy as np
from pyspark.sql import functions as F

from reverbkit.operators import pairing as P


def frames(spark, comments, chunks):
    c = spark.createDataFrame([(v, i, x) for v, i, x in comments], "video_id long, comment_id long, vec array<double>")
    k = spark.createDataFrame([(v, i, x) for v, i, x in chunks], "video_id long, chunk_index int, vec array<double>")
    return c, k


def brute(comments, chunks):
    out = {}
    for v, i, x in comments:
        best = None
        for _, k, y in (c for c in chunks if c[0] == v):
            a, b = (np.nan_to_num(np.array(z if z is not None else [0.0], float)) for z in (x, y))
            a, b = (np.pad(z, (0, max(len(a), len(b)) - len(z))) for z in (a, b))
            den = np.linalg.norm(a) * np.linalg.norm(b)
            sim = a @ b / den if den > 0 else 0.0
            if best is None or (round(sim, 12), -k) > best[0]:
                best = ((round(sim, 12), -k), k, sim)
        if best:
            out[v, i] = best[1:]
    return out


def clustered(seed=3, clusters=40, size=8, dims=16, comments=300, noise=0.05):
    """Chunks in runs about a direction each, as neighbouring windows of a text are."""
    r = np.random.default_rng(seed)
    centres = r.normal(size=(clusters, dims))
    chunks = [(1, 1 + k, (centres[k // size] + noise * r.normal(size=dims)).tolist()) for k in range(clusters * size)]
    asked = [(1, i, (centres[r.integers(clusters)] + noise * r.normal(size=dims)).tolist()) for i in range(comments)]
    return asked, chunks


def same(got, want):
    assert {(r["video_id"], r["comment_id"]) for r in got} == set(want)
    for r in got:
        k, sim = want[r["video_id"], r["comment_id"]]
        assert r["chunk_index"] == k and abs(r["similarity"] - sim) < 1e-9


def test_several_blocks_and_salts(spark):
    r = np.random.default_rng(5)
    asked, chunks = clustered(clusters=9, comments=60)
    chunks += [(2, k, r.normal(size=16).tolist()) for k in range(1, 30)] + [(2, 30, [0.0] * 16), (2, 31, None), (3, 1, [1.0] * 16)]
    chunks += [(2, 32, chunks[80][2])]  # a repeated vector: the lower index wins
    asked += [(2, 500 + i, r.normal(size=16).tolist()) for i in range(40)] + [(2, 600, [0.0] * 16), (2, 601, None), (2, 602, [-x for x in chunks[80][2]]), (4, 700, [1.0] * 16)]
    c, k = frames(spark, asked, chunks)
    want = brute(asked, chunks)
    for block, rows in ((4, 65_536), (8, 7), (256, 5)):
        same(P.nearest_chunk(c, k, block_size=block, rows_per_salt=rows).collect(), want)


def test_payloads_come_along(spark):
    asked, chunks = clustered(clusters=5, comments=30)
    c, k = frames(spark, asked, chunks)
    c = c.withColumn("mark", F.struct(F.col("comment_id").alias("x"), F.array(F.lit("é")).alias("y")))
    k = k.withColumn("text", F.concat(F.lit("chunk "), F.col("chunk_index")))
    for block in (8, 256):
        for r in P.nearest_chunk(c, k, block_size=block, comment_payload=["mark"], chunk_payload=["text"]).collect():
            assert r["mark"]["x"] == r["comment_id"] and r["text"] == f"chunk {r['chunk_index']}" and r["mark"]["y"] == ["é"]


def test_blocks_that_cannot_win_are_skipped(spark):
    asked, chunks = clustered()
    c, k = frames(spark, asked, chunks)
    same(P.nearest_chunk(c, k, block_size=8).collect(), brute(asked, chunks))
    kc = k.select("video_id", F.floor((F.col("chunk_index") - 1) / 8).cast("long").alias("_block"), F.col("vec").alias("_w"))
    bounds = P.block_bounds(kc, "video_id")
    assert bounds.count() == 40
    # with the true best known, nearly all of the 39 other blocks are excluded
    best = {i: float(s) for (_, i), (_, s) in brute(asked, chunks).items()}
    known = spark.createDataFrame([(1, i, x, best[i], -1) for _, i, x in asked], "video_id long, comment_id long, _v array<double>, _rank double, _home long")
    left = P.blocks_left(known, bounds, "video_id", "comment_id").count()
    assert 300 <= left <= 0.05 * 300 * 40
    # and none that holds the winner
    kept = {(r["comment_id"], r["_block"]) for r in P.blocks_left(known, bounds, "video_id", "comment_id").collect()}
    assert all((i, (k - 1) // 8) in kept for (_, i), (k, _) in brute(asked, chunks).items())


def test_empty_sides(spark):
    asked, chunks = clustered(clusters=2, comments=3)
    c, k = frames(spark, asked, chunks)
    assert P.nearest_chunk(c.limit(0), k, block_size=4).collect() == []
    assert P.nearest_chunk(c, k.limit(0)).collect() == []
    assert P.nearest_chunk(c.limit(0), k).collect() == []


def test_time_of_a_pair(spark):
    """4 million pairs of 64 numbers; interpreted lambdas took about 20 us for each."""
    r = np.random.default_rng(1)
    vec = lambda n: [(1, i + 1, x) for i, x in enumerate(r.normal(size=(n, 64)).tolist())]
    c, k = frames(spark, vec(4000), vec(1000))
    c, k = c.repartition(8).cache(), k.cache()
    c.count(), k.count()
    P.nearest_chunk(c, k, block_size=1000).write.format("noop").mode("overwrite").save()
    t = time.perf_counter()
    P.nearest_chunk(c, k, block_size=1000, rows_per_salt=500).write.format("noop").mode("overwrite").save()
    took = (time.perf_counter() - t) * spark.sparkContext.defaultParallelism / 4e6
    c.unpersist(), k.unpersist()
    assert took < 4e-6, took


def test_rows_for_blocks_leave_in_bounded_tables(spark, monkeypatch):
    """No block can be excluded: every comment meets every block, 32 rows at a time."""
    r = np.random.default_rng(8)
    chunks = [(1, k, x) for k, x in enumerate(r.normal(size=(40, 8)).tolist(), 1)]
    asked = [(1, i, x) for i, x in enumerate(r.normal(size=(50, 8)).tolist())]
    c, k = frames(spark, asked, chunks)
    monkeypatch.setattr(P, "TAKEN", 32)
    sizes, meet = spark.sparkContext.accumulator(0), P._meet

    def counted(*args):
        *head, found, schema = args

        def told(a, b):
            for table in found(a, b):
                sizes.add(table.num_rows > 50)
                yield table

        return meet(*head, told, schema)

    monkeypatch.setattr(P, "_meet", counted)
    c = c.withColumn("mark", F.when(F.col("comment_id") > 9, F.col("comment_id")))
    rows = P.nearest_chunk(c, k, block_size=4, comment_payload=["mark"]).collect()
    same(rows, brute(asked, chunks))
    assert all(x["mark"] == (x["comment_id"] if x["comment_id"] > 9 else None) for x in rows)
    assert sizes.value == 0
