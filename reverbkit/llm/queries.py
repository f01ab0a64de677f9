"""Driver queries of the operators: ``opN_<name>(spark, sf_dir)`` applies
operator N with production parameters to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reverbkit.llm import decontaminate, infill, langid, neighbours, packing, pieces, pii, secrets, simhash, spelling, substrings, toxicity, vectors
from reverbkit.llm.common import learn_fold, read, texts
from reverbkit.llm.oracle import ORACLE


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(read(spark, sf_dir, "embeddings"), cosine=0.95)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    fold = learn_fold("doc_id", 5)
    grammar = toxicity.learn(texts(docs), read(spark, sf_dir, "labels").where(fold != 0))
    return toxicity.score(docs, grammar).select(
        "doc_id", (fold == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_duplicates(read(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read(spark, sf_dir, "documents"))

    def spelled(column: str) -> Column:
        return F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in secrets.KINDS]
    return found.select("doc_id", *counts, F.sha2(spelled("base").cast("binary"), 256).alias("base_sha256"), spelled("spans").alias("spans"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    fold = learn_fold("doc_id", 3)
    filters = langid.learn(docs.where(fold != 1))
    return langid.identify(docs, filters).select("doc_id", (fold == 1).alias("held_out"), "lang_pred", "score")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_pii(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids' number and CRC-32 (little-endian unsigned 32-bit ids), and
    whether decoding them gives the text back."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = read(spark, sf_dir, "documents")
    return pieces.round_trip(docs, model)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(read(spark, sf_dir, "documents"), length=13).drop("text")


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), length=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, sf_dir, "documents"), least_length=7, least_count=2, drop_every=31, ratio=10)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.fill_in_middle(read(spark, sf_dir, "documents"), seed="1", plain_percent=10, spm_percent=20)

    def sha256(text: Column) -> Column:
        return F.sha2(text.cast("binary"), 256)

    restored = infill.restore(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha256(F.col("output")).alias("output_sha256"), sha256(restored).alias("restored_sha256"))


QUERIES = {
    "op1_near_vectors": op1_near_vectors,
    "op2_toxicity": op2_toxicity,
    "op3_simhash": op3_simhash,
    "op4_secrets": op4_secrets,
    "op5_language": op5_language,
    "op6_pii": op6_pii,
    "op7_pieces": op7_pieces,
    "op8_packing": op8_packing,
    "op9_neighbours": op9_neighbours,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_decontaminate": op11_decontaminate,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_fill_in_middle": op13_fill_in_middle,
}

__all__ = ["ORACLE", "QUERIES"]
