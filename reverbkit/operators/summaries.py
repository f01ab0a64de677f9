"""Extracts of transcripts by a walk over their sentences.

The sentences of a video are a graph: an edge weighs the cosine of two
sentences' term counts. A sentence's rank is what a damped random walk gives
it after a fixed number of rounds (Mihalcea and Tarau, "TextRank", 2004).
The edges are never written. With the sentences' unit vectors as rows of V,
a round is V (V' (rank / degree)) less a sentence's edge to itself: one sum per
(video, term) and one per (video, sentence), so the work of a round grows with
the number of distinct terms of all sentences, not with pairs of sentences.
Videos of at most ``GROUP_ROWS`` weights (a bounded group) walk all rounds in one
group; of larger ones no video is gathered in one task, their sums are joins
and their ranks are written after each round.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from reverbkit.session import cut_lineage

SENTENCES, ROUNDS, DAMPING = 3, 5, 0.85
SENTENCE_END = r"[.!?\n]+"
TERM_GAP = r"[ \t\r\n,;:()\"]+"
#: Degrees up to this are sums of rounding errors: the sentence shares no term.
NO_EDGE = 1e-9
#: Ranks count as equal up to this many places, so that ties do not hang on the order of sums.
PLACES = 9
#: Weights (terms of sentences) of a video that walks in one group.
GROUP_ROWS = 1 << 18


def sentences(segments: DataFrame, key: str = "video_id", order: str = "seg_idx", text: str = "segment") -> DataFrame:
    """(key, seg, pos, sentence) of all sentences that hold a term."""
    s = segments.select(F.col(key).alias("video_id"), F.col(order).alias("seg"), F.posexplode(F.split(text, SENTENCE_END)).alias("pos", "sentence"))
    s = s.withColumn("sentence", F.trim(F.translate("sentence", "\t\r", "  ")))
    return s.where(F.size(F.filter(F.split("sentence", TERM_GAP), lambda t: t != "")) > 0)


def term_weights(sents: DataFrame) -> DataFrame:
    """(video_id, seg, pos, term, w): the terms of a sentence as a vector of length 1.
    Only A-Z are lower-cased."""
    lower = F.translate("sentence", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = sents.select("video_id", "seg", "pos", F.explode(F.split(lower, TERM_GAP)).alias("term")).where("term != ''")
    n = terms.groupBy("video_id", "seg", "pos", "term").agg(F.count(F.lit(1)).cast("double").alias("n"))
    norm = n.groupBy("video_id", "seg", "pos").agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("norm"))
    return n.join(norm, ["video_id", "seg", "pos"]).select("video_id", "seg", "pos", "term", (F.col("n") / F.col("norm")).alias("w"))


def _through_terms(weights: DataFrame, values: DataFrame | None) -> DataFrame:
    """(video_id, seg, pos, total): for each sentence the sum of the others' values
    (1 without ``values``) by edge weight, its own included."""
    given = weights.withColumn("x", F.col("w")) if values is None else weights.join(values, ["video_id", "seg", "pos"]).withColumn("x", F.col("w") * F.col("value"))
    by_term = given.groupBy("video_id", "term").agg(F.sum("x").alias("x"))
    return weights.join(by_term, ["video_id", "term"]).groupBy("video_id", "seg", "pos").agg(F.sum(F.col("w") * F.col("x")).alias("total"))


def _walk_in_groups(weights: DataFrame, rounds: int, damping: float) -> DataFrame:
    """(video_id, seg, pos, rank) of videos that are groups of bounded size."""
    at = ["video_id", "seg", "pos"]

    def walk(t: pa.Table) -> pa.Table:
        seg, pos = pc.index_in(t["seg"], pc.unique(t["seg"])).to_numpy().astype(np.int64), t["pos"].to_numpy().astype(np.int64)
        _, first, sent = np.unique(seg * (pos.max() + 1) + pos, return_index=True, return_inverse=True)
        term, w = pc.index_in(t["term"], pc.unique(t["term"])).to_numpy(), t["w"].to_numpy()

        def through(values: np.ndarray) -> np.ndarray:
            by_term = np.bincount(term, w * values[sent])
            return np.bincount(sent, w * by_term[term])

        rank = np.ones(len(first))
        degree = through(rank) - 1
        linked = degree > NO_EDGE
        for _ in range(rounds):
            value = np.divide(rank, degree, out=np.zeros_like(rank), where=linked)
            rank = 1 - damping + damping * np.where(linked, through(value) - value, 0.0)
        return t.select(at).take(pa.array(first)).append_column("rank", pa.array(rank))

    schema = T.StructType([weights.schema[c] for c in at]).add("rank", "double")
    return weights.groupBy("video_id").applyInArrow(walk, schema)


def _walk_by_joins(weights: DataFrame, rounds: int, damping: float) -> DataFrame:
    """(video_id, seg, pos, rank) of videos of any size."""
    at = ["video_id", "seg", "pos"]
    own = F.col("total") - 1
    degrees = _through_terms(weights, None).select(*at, F.when(own > NO_EDGE, own).alias("degree"))
    degrees = cut_lineage(degrees.withColumn("rank", F.lit(1.0)), "ranks")
    for _ in range(rounds):
        value = degrees.select(*at, "degree", F.coalesce(F.col("rank") / F.col("degree"), F.lit(0.0)).alias("value"))
        come = value.join(_through_terms(weights, value.select(*at, "value")), at)
        rank = 1 - damping + damping * F.when(F.col("degree").isNotNull(), F.col("total") - F.col("value")).otherwise(0.0)
        degrees = cut_lineage(come.select(*at, "degree", rank.alias("rank")), "ranks")
    return degrees.select(*at, "rank")


def sentence_ranks(weights: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(video_id, seg, pos, rank) after ``rounds`` rounds from rank 1 everywhere; a
    sentence that shares no term with another keeps 1 - ``damping``."""
    large = cut_lineage(weights.groupBy("video_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group_rows).select("video_id"), "large")
    if large.isEmpty():
        return _walk_in_groups(weights, rounds, damping)
    # the large videos' weights are read in every round
    apart = cut_lineage(weights.join(large, "video_id", "left_semi"), "large-weights")
    return _walk_in_groups(weights.join(large, "video_id", "left_anti"), rounds, damping).unionByName(_walk_by_joins(apart, rounds, damping))


def summarise(segments: DataFrame, key: str = "video_id", order: str = "seg_idx", text: str = "segment",
              n: int = SENTENCES, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """(key, n_sentences, summary): the ``n`` sentences of highest rank in the order
    they are spoken, ". " between them and "." behind; of equal ranks the earlier
    sentence is taken.

    Fewer sentences give them all. A null or empty text holds none, and a video
    without a sentence has no row. Rows that share (key, order) count as one segment
    whose sentences at one place pool their terms, spelled as the smallest of them.
    Other columns are ignored."""
    sents = sentences(segments, key, order, text)
    ranks = cut_lineage(sentence_ranks(cut_lineage(term_weights(sents), "weights"), rounds, damping), "ranks")
    best = Window.partitionBy("video_id").orderBy(F.desc(F.round("rank", PLACES)), "seg", "pos")
    chosen = ranks.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= n)
    spelled = sents.join(chosen.select("video_id", "seg", "pos"), ["video_id", "seg", "pos"]).groupBy("video_id", "seg", "pos").agg(F.min("sentence").alias("sentence"))
    whole = spelled.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("seg", "pos", "sentence"))).alias("s"))
    counts = ranks.groupBy("video_id").agg(F.count(F.lit(1)).alias("n_sentences"))
    summary = F.concat(F.array_join(F.transform("s", lambda x: x["sentence"]), ". "), F.lit("."))
    return counts.join(whole, "video_id").select(F.col("video_id").alias(key), "n_sentences", summary.alias("summary"))
