"""Driver queries over text: comments, transcripts, chunks, pairing by terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reverbkit.functions.text import clean_transcript, expand_slang, valid_comments, words
from reverbkit.operators.chunks import (
    assemble_transcript,
    chunk_segments,
    chunk_text,
    transcript_word_counts,
)
from reverbkit.operators import termvectors
from reverbkit.operators.pairing import nearest_chunk, pair_counts, tfidf_nearest_chunk
from reverbkit.plans.variants import COMMENT_VARIANTS, SLANG_VARIANTS, TRANSCRIPT_VARIANTS, wrap
from reverbkit.sources.tables import (
    conversation_comments,
    conversation_segments,
    conversation_videos,
    table,
)


def raw_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the fixed comment variants mixed in."""
    c = conversation_comments(spark, sf_dir)
    sel = F.pmod(F.col("video_id") + F.col("comment_pos"), F.lit(len(COMMENT_VARIANTS)))
    return c.withColumn("raw_comment", wrap(F.col("raw_comment"), sel, COMMENT_VARIANTS))


def cleaned_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F10 + P1: valid cleaned comments (video_id, comment_pos, comment)."""
    c = raw_comments(spark, sf_dir)
    return valid_comments(c, "raw_comment", "comment").select("video_id", "comment_pos", "comment")


def distinct_comments(comments: DataFrame) -> DataFrame:
    """One row per distinct (video, comment text), first position kept."""
    return comments.groupBy("video_id", "comment").agg(
        F.min("comment_pos").alias("comment_pos"), F.count(F.lit(1)).alias("n_copies")
    )


def transcript_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_segments(conversation_segments(spark, sf_dir), "video_id", "seg_idx", "segment")


def q_clean_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned_comments(spark, sf_dir)


def q_distinct_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_comments(cleaned_comments(spark, sf_dir))


def q_slang_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    sel = F.pmod(F.col("doc_id"), F.lit(len(SLANG_VARIANTS)))
    t = F.lower(wrap(F.col("text"), sel, SLANG_VARIANTS))
    return d.select("doc_id", expand_slang(t).alias("expanded"))


def _docs_with_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    sel = F.pmod(F.col("doc_id"), F.lit(len(TRANSCRIPT_VARIANTS)))
    return d.select(F.col("doc_id").alias("video_id"), wrap(F.col("text"), sel, TRANSCRIPT_VARIANTS).alias("transcript"))


def q_clean_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs_with_variants(spark, sf_dir)
    return d.select("video_id", clean_transcript(F.col("transcript")).alias("transcript"))


def q_chunk_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs_with_variants(spark, sf_dir)
    ch = chunk_text(d, "video_id", "transcript")
    return ch.select("video_id", "chunk_index", "chunk", F.size(words(F.col("chunk"))).alias("n_words"))


def q_transcript_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble_transcript(conversation_segments(spark, sf_dir), "video_id", "seg_idx", "segment")


def q_segment_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcript_chunks(spark, sf_dir)


def q_pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_counts(cleaned_comments(spark, sf_dir), transcript_chunks(spark, sf_dir), "video_id")


def q_rejected_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos the reference would stop on, with the first failed check."""
    vids = conversation_videos(spark, sf_dir)
    nw = transcript_word_counts(conversation_segments(spark, sf_dir), "video_id", "segment")
    nc = cleaned_comments(spark, sf_dir).groupBy("video_id").agg(F.count(F.lit(1)).alias("n_comments"))
    j = vids.join(nw, "video_id", "left").join(nc, "video_id", "left")
    reason = (
        F.when(F.coalesce("n_words", F.lit(0)) == 0, F.lit("no_transcript"))
        .when(F.coalesce("n_comments", F.lit(0)) == 0, F.lit("no_comments"))
    )
    return j.select("video_id", reason.alias("reason")).where(F.col("reason").isNotNull())


def q_tfidf_nearest_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reverbkit.session import cut_lineage

    # both inputs feed several branches of the search: materialise each once
    # in the shared checkpoint folder instead of re-running the chunker
    comments = cut_lineage(distinct_comments(cleaned_comments(spark, sf_dir)))
    chunks = cut_lineage(transcript_chunks(spark, sf_dir))
    nn = tfidf_nearest_chunk(comments, chunks, key="video_id", comment_key="comment_pos",
                             comment_text="comment", chunk_text="chunk")
    from reverbkit.functions.vectors import round_half_up

    return nn.select("video_id", "comment_pos", "chunk_index", round_half_up(F.col("similarity"), 6).alias("similarity"))


TEXT_DIMS = 32


def q_dense_text_nearest_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 + J2: the nearest chunk by text vectors learned from the same texts."""
    from reverbkit.functions.vectors import round_half_up
    from reverbkit.session import cut_lineage

    comments, chunks, vectors, idf = learned_texts(spark, sf_dir)
    c = cut_lineage(termvectors.text_vectors(comments, ["video_id", "comment_pos"], "comment", vectors, idf, TEXT_DIMS), "comment-vectors")
    k = cut_lineage(termvectors.text_vectors(chunks, ["video_id", "chunk_index"], "chunk", vectors, idf, TEXT_DIMS), "chunk-vectors")
    nn = nearest_chunk(c, k, comment_key="comment_pos")
    return nn.select("video_id", "comment_pos", "chunk_index", round_half_up(F.col("similarity"), 6).alias("similarity"))


def learned_texts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The distinct comments, the chunks, and term vectors and idf learned from both."""
    from reverbkit.session import cut_lineage

    comments = cut_lineage(distinct_comments(cleaned_comments(spark, sf_dir)).select("video_id", "comment_pos", "comment"), "comments")
    chunks = cut_lineage(transcript_chunks(spark, sf_dir).select("video_id", "chunk_index", "chunk"), "chunks")
    texts = comments.select(F.col("comment").alias("text")).unionByName(chunks.select(F.col("chunk").alias("text")))
    vectors, _ = termvectors.learn(texts, "text", TEXT_DIMS, min_count=5, rounds=3)
    return comments, chunks, vectors, termvectors.inverse_frequency(chunks, "chunk")


TEXT_QUERIES = {
    "clean_comments": q_clean_comments,
    "distinct_comments": q_distinct_comments,
    "slang_expand": q_slang_expand,
    "clean_transcripts": q_clean_transcripts,
    "chunk_transcripts": q_chunk_transcripts,
    "transcript_assembly": q_transcript_assembly,
    "segment_chunks": q_segment_chunks,
    "pair_counts": q_pair_counts,
    "rejected_videos": q_rejected_videos,
    "tfidf_nearest_chunk": q_tfidf_nearest_chunk,
    "dense_text_nearest_chunk": q_dense_text_nearest_chunk,
}
