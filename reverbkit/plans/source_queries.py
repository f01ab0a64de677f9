"""Driver queries over page, record and engagement sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reverbkit.constants import TOP_COMMENTS
from reverbkit.functions import fields as FX
from reverbkit.operators.report import engagement_bands, engagement_counts, engagement_metrics, top_comments
from reverbkit.sources.tables import table


def q_page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 + S12 + S17: title, language and tags of every stored page."""
    p = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    tags = FX.page_tags(F.col("html"))
    return p.select(
        "page_id", "url",
        FX.page_title(F.col("html")).alias("title"),
        FX.page_lang(F.col("html")).alias("lang"),
        F.array_join(tags, "|").alias("tags"),
        F.size(tags).alias("n_tags"),
    )


def record_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formatted label strings built from ``orders`` (the pages hold none):
    the view/date line, comment-count text, like-button label, subscriber
    text and channel name of one record per order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    price = F.floor(F.col("o_totalprice")).cast("long")
    views = F.when(F.pmod("o_orderkey", F.lit(10)) == 9, F.lit("1.5")).otherwise(F.format_number(price, 0))
    date = F.when(
        F.pmod("o_orderkey", F.lit(2)) == 0, F.date_format("o_orderdate", "d MMM yyyy")
    ).otherwise(F.date_format("o_orderdate", "MMM d, yyyy"))
    p10 = F.floor(F.col("o_totalprice") * 10).cast("long")
    subs = (
        F.when(p10 >= 1_000_000, F.concat((p10 / 1_000_000).cast("long").cast("string"), F.lit("."),
                                          F.lpad(F.pmod((p10 / 10_000).cast("long"), F.lit(100)).cast("string"), 2, "0"),
                                          F.lit("M subscribers")))
        .when(p10 >= 1000, F.concat((p10 / 1000).cast("long").cast("string"), F.lit("."),
                                    F.pmod((p10 / 100).cast("long"), F.lit(10)).cast("string"), F.lit("K subscribers")))
        .otherwise(F.concat(p10.cast("string"), F.lit(" subscribers")))
    )
    return o.select(
        F.col("o_orderkey").alias("record_id"),
        F.concat(views, F.lit(" views "), date).alias("info"),
        F.concat(F.format_number(F.col("o_custkey"), 0), F.lit(" Comments")).alias("comment_text"),
        F.concat(F.lit("like this video along with "), F.format_number(F.col("o_custkey") * 37, 0),
                 F.lit(" other people")).alias("like_label"),
        F.concat(F.lit("  "), subs, F.lit(" ")).alias("subscriber_text"),
        F.concat(F.lit(" Channel "), F.col("o_custkey").cast("string"), F.lit(" ")).alias("channel_text"),
    )


def q_parse_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and dates parsed back from the label strings."""
    r = record_strings(spark, sf_dir)
    d = FX.upload_date(F.col("info"))
    return r.select(
        "record_id",
        FX.views_from_info(F.col("info")).alias("views"),
        d.alias("upload_date"),
        FX.upload_dt(d).alias("upload_dt"),
        FX.likes_from_label(F.col("like_label")).alias("likes"),
        FX.count_digits(F.col("comment_text")).alias("comment_count"),
        F.trim(F.col("channel_text")).alias("channel_name"),
        FX.subscriber_count(F.col("subscriber_text")).alias("subscriber_count"),
    )


def q_top_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 most popular entries per video (events: value = popularity)."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("video_id"), "event_id", "value")
    return top_comments(e, "video_id", "value", "event_id", TOP_COMMENTS).select("video_id", "event_id", "value", "rank")


def q_engagement_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_type")
    return engagement_metrics(engagement_counts(e, "user_id"))


def q_engagement_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_type")
    return engagement_bands(engagement_metrics(engagement_counts(e, "user_id")))


def q_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: word tokens per document and what truncation at 64 / 128 keeps."""
    from reverbkit.operators.train import TOKEN_PATTERN

    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    toks = d.select("doc_id", F.regexp_extract_all(F.lower(F.col("text")), F.lit(TOKEN_PATTERN), 0).alias("tokens"))
    n = F.size("tokens")
    return toks.select(
        "doc_id", n.alias("n_tokens"),
        F.least(n, F.lit(64)).alias("kept_64"), F.least(n, F.lit(128)).alias("kept_128"),
        (n > 64).alias("truncated_64"),
    )


SOURCE_QUERIES = {
    "page_fields": q_page_fields,
    "parse_counts": q_parse_counts,
    "top_comments": q_top_comments,
    "engagement_metrics": q_engagement_metrics,
    "engagement_bands": q_engagement_bands,
    "token_lengths": q_token_lengths,
}
