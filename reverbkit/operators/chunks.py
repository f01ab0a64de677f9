"""Transcripts: assembly, cleaning, overlapping word windows.

Two chunkers with identical output:

* ``chunk_text`` - for a transcript that is already one value (a document
  row): ``split`` -> ``sequence`` of window starts -> ``slice`` +
  ``array_join`` -> ``posexplode``. Narrow, no shuffle.
* ``chunk_segments`` - for a transcript stored as ordered segments (one row
  per segment). The transcript is never gathered into one row: each
  segment's words get global positions from a two-level prefix sum over
  segment word counts, the segment is cut into one piece per window it
  overlaps, and each window is rebuilt by a group-by on (video, window)
  whose groups hold at most ``size`` words. A hot video is spread over all
  tasks.

Both follow ``str.split()`` + ``range(0, n, size - overlap)``: n words give
``ceil(n / step)`` windows, the last may lie inside the one before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reverbkit.constants import CHUNK_OVERLAP, CHUNK_WORDS
from reverbkit.functions.text import clean_transcript, words

SEG_BUCKET = 1024  # segments per prefix-sum bucket


def _step(size: int, overlap: int) -> int:
    step = size - overlap
    if step == 0:
        raise ValueError("chunk overlap must differ from chunk size (window step would be 0)")
    return step


def chunk_array(w: Column, size: int = CHUNK_WORDS, overlap: int = CHUNK_OVERLAP) -> Column:
    """W1 over a word-array column (empty for no words or a negative step).

    ``w`` must be a column reference: it is used both outside and inside the
    lambda, which keeps Catalyst from inlining (and re-running) the split.
    """
    step = _step(size, overlap)
    if step < 0:
        return F.array().cast("array<string>")
    n = F.size(w)
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda s: F.array_join(F.slice(w, s + 1, size), " "))


def chunk_text(df: DataFrame, key: str, text_col: str, size: int = CHUNK_WORDS,
               overlap: int = CHUNK_OVERLAP, clean: bool = True) -> DataFrame:
    """(key, chunk_index 1-based, chunk) for one-row transcripts."""
    t = clean_transcript(F.col(text_col)) if clean else F.col(text_col)
    w = df.select(key, words(t).alias("_w"))
    return w.select(key, F.posexplode(chunk_array(F.col("_w"), size, overlap)).alias("pos", "chunk")).select(
        key, (F.col("pos") + 1).cast("int").alias("chunk_index"), "chunk"
    )


def assemble_transcript(segments: DataFrame, key: str = "video_id", order: str = "seg_idx",
                        text: str = "segment") -> DataFrame:
    """Segment texts in order, each followed by a newline.

    The output *is* one string per video, so each video's segments meet in
    one group; chunking never needs this (see ``chunk_segments``).
    """
    return segments.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_segments"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct(F.col(order), F.col(text)))), lambda s: F.concat(s[text], F.lit("\n"))),
            "",
        ).alias("transcript"),
    )


def segment_word_offsets(segments: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """(key, order, seg_words array<string>, offset): words of each cleaned
    segment and the number of words before it in the video.

    Prefix sums in two levels so no window partition exceeds SEG_BUCKET rows
    or the number of buckets of one video.
    """
    seg = segments.select(
        key, order, words(clean_transcript(F.col(text))).alias("seg_words")
    ).withColumn("_n", F.size("seg_words")).withColumn("_b", F.floor(F.col(order) / SEG_BUCKET))
    per_bucket = seg.groupBy(key, "_b").agg(F.sum("_n").alias("_bn"))
    wb = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bucket_off = per_bucket.select(key, "_b", (F.sum("_bn").over(wb) - F.col("_bn")).alias("_boff"))
    ws = Window.partitionBy(key, "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seg = seg.withColumn("_soff", F.sum("_n").over(ws) - F.col("_n"))
    return seg.join(bucket_off, [key, "_b"]).select(
        key, order, "seg_words", (F.col("_boff") + F.col("_soff")).alias("offset"), F.col("_n").alias("n_words")
    )


def chunk_segments(segments: DataFrame, key: str = "video_id", order: str = "seg_idx",
                   text: str = "segment", size: int = CHUNK_WORDS,
                   overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """(key, chunk_index, chunk) for segmented transcripts, fully distributed.

    Each segment (words at global positions [o, o + n)) emits one *piece*
    per window k it overlaps - the words of [k*step, k*step + size) that it
    holds - so rows shipped are about n / step + 2 per segment, not one per
    word. A window's pieces meet in one group (at most ``size`` words) and
    are joined in position order.
    """
    step = _step(size, overlap)
    if step < 0:
        return segments.sparkSession.createDataFrame([], f"{key} long, chunk_index int, chunk string")
    segw = segment_word_offsets(segments, key, order, text).where(F.col("n_words") > 0)
    o, n = F.col("offset"), F.col("n_words")
    k_lo = F.greatest(F.lit(0), F.ceil((o - size + 1) / step))
    k_hi = F.floor((o + n - 1) / step)
    ks = F.when(k_lo <= k_hi, F.sequence(k_lo, k_hi)).otherwise(F.array().cast("array<bigint>"))
    per_window = segw.select(key, "offset", "n_words", "seg_words", F.explode(ks).alias("k"))
    start = F.greatest(F.col("k") * step, o)
    end = F.least(F.col("k") * step + size, o + n)
    pieces = per_window.select(
        key, "k", start.alias("p"),
        F.slice("seg_words", (start - o + 1).cast("int"), (end - start).cast("int")).alias("piece"),
    ).where(F.size("piece") > 0)
    return (
        pieces.groupBy(key, "k")
        .agg(F.array_sort(F.collect_list(F.struct("p", "piece"))).alias("ps"))
        .select(
            key,
            (F.col("k") + 1).cast("int").alias("chunk_index"),
            F.array_join(F.flatten(F.transform("ps", lambda x: x["piece"])), " ").alias("chunk"),
        )
    )


def transcript_word_counts(segments: DataFrame, key: str = "video_id", text: str = "segment") -> DataFrame:
    """Words of the cleaned transcript per video (partial aggregate)."""
    return segments.groupBy(key).agg(
        F.sum(F.size(words(clean_transcript(F.col(text))))).alias("n_words")
    )
