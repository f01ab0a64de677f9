"""Cleaning a corpus for training: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet to the shared checkpoint folder and rereads it as the next one's
docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reverbkit.llm import packing, pii, simhash, substrings, toxicity
from reverbkit.llm.common import cut_lineage, read, texts


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar scores 0.5 or more go."""
    grammar = toxicity.learn(texts(docs), read(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, grammar)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their SimHash, the one with the smallest id stays, and
    of those that share it the one whose text has the smallest hash; rows without
    an id come last. Rows equal in id and text are one document."""
    key = F.struct(F.col("doc_id").isNull(), "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256))
    rows = docs.select(key.alias("row_key"), "text")
    kept = simhash.simhash_duplicates(rows, shingle=3, max_bits=3, id_col="row_key").where("doc_id = component_id").select(F.col("doc_id").alias("row_key")).distinct()
    named = docs.select(key.alias("row_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return named.join(kept, "row_key", "left_semi").dropDuplicates(["row_key"]).select("row.*")


def remove_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of 13-word windows that a document with a smaller id has go; a
    document that loses all its words stays, with an empty text."""
    rows = substrings.remove_repeats(docs, length=13, carry=True)
    kept = [F.col("text") if c == "text" else F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"row.`{c}`") for c in docs.columns]
    return rows.select(kept)


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by surrogates."""
    rows = pii.replace_pii(docs, count_col=None)
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row per piece of a document."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("substrings", remove_passages),
    ("pii", replace_private),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs


#: The learned grammar, the hash fingerprints and the tokenizer are not SQL.
ORACLE_SQL = None
