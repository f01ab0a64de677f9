"""Driver queries of the record and CSV sources."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reverbkit.session import checkpoint_dir
from reverbkit.sources.io import read_csv, require_columns, write_table
from reverbkit.sources.records import video_fields
from reverbkit.sources.tables import table


def record_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON record per order (the tables hold none), with keys that are absent,
    null or of another type, and some records cut off."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("record_id"), "o_custkey", "o_orderdate")

    def given(modulus: int, present: str, null_at: int | None) -> str:
        null = f"when record_id % {modulus} = {null_at} then '\"{{0}}\": null'" if null_at is not None else ""
        return f"case when record_id % {modulus} = 0 then null {null} else {present} end"

    parts = {
        "title": given(5, "concat('\"{0}\": \"Order ', record_id, ' \\\\\"quoted\\\\\" é\"')", 1),
        "channel_name": given(3, "concat('\"{0}\": \"Clerk ', o_custkey, '\"')", None),
        "upload_date": given(4, "concat('\"{0}\": \"', date_format(o_orderdate, 'yyyy-MM-dd'), '\"')", 1),
        "tags": given(6, "concat('\"{0}\": [\"a', record_id % 9, '\", \"b\"]')", 1),
        "views": given(7, "if(record_id % 7 = 2, '\"{0}\": \"12x\"', concat('\"{0}\": ', o_custkey))", 1),
    }
    whole = ", ".join(sql.format(name) for name, sql in parts.items())
    text = f"concat('{{', concat_ws(', ', {whole}), '}}')"
    return o.select("record_id", F.expr(f"if(record_id % 13 = 0, substr({text}, 1, length({text}) - 1), {text})").alias("json"))


def q_video_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S7: an absent key takes its default, a JSON null stays null, a record that
    is cut off is corrupt."""
    fields = ["title", "channel_name", "upload_date", "tags", "views"]
    r = video_fields(record_texts(spark, sf_dir), "json", ["record_id"], fields)
    return r.select("record_id", "title", "channel_name", "upload_date", F.array_join("tags", "|").alias("tags"),
                    F.when(F.col("tags").isNotNull(), F.size("tags")).alias("n_tags"), "views", F.col("corrupt_record").isNotNull().alias("corrupt"))


def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + S4 + S5: whole texts (quotes, commas, line ends, the words null and nan,
    blanks at both ends) written as CSV and read again."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    word = F.element_at(F.array(*[F.lit(x) for x in ("null", "nan", "", ' "q", ')]), (F.pmod("doc_id", F.lit(4)) + 1).cast("int"))
    rows = require_columns(d.select("doc_id", "text", word.alias("word"), F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(" "), "text", F.lit("\n "))).alias("padded")), ["doc_id", "text"])
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/csv-{uuid.uuid4().hex}"
    write_table(rows, path, "csv")
    schema = T.StructType().add("doc_id", "long").add("text", "string").add("word", "string").add("padded", "string")
    again = read_csv(spark, path, schema)
    return again.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), "word", F.sha2(F.col("padded").cast("binary"), 256).alias("padded_sha256"))


RECORD_QUERIES = {
    "video_defaults": q_video_defaults,
    "csv_roundtrip": q_csv_roundtrip,
}

ORACLE_RECORDS = {
    "video_defaults": """
WITH r AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS d, o_orderkey % 13 = 0 AS corrupt FROM orders)
SELECT k AS record_id,
  CASE WHEN corrupt OR k % 5 = 1 THEN NULL WHEN k % 5 = 0 THEN 'No Title' ELSE 'Order ' || k || ' "quoted" é' END AS title,
  CASE WHEN corrupt THEN NULL WHEN k % 3 = 0 THEN 'Unknown Channel' ELSE 'Clerk ' || c END AS channel_name,
  CASE WHEN corrupt OR k % 4 = 1 THEN NULL WHEN k % 4 = 0 THEN 'Unknown Date' ELSE strftime(d, '%Y-%m-%d') END AS upload_date,
  CASE WHEN corrupt OR k % 6 = 1 THEN NULL WHEN k % 6 = 0 THEN '' ELSE 'a' || (k % 9) || '|b' END AS tags,
  CAST(CASE WHEN corrupt OR k % 6 = 1 THEN NULL WHEN k % 6 = 0 THEN 0 ELSE 2 END AS INTEGER) AS n_tags,
  CAST(CASE WHEN corrupt OR k % 7 IN (1, 2) THEN NULL WHEN k % 7 = 0 THEN 0 ELSE c END AS BIGINT) AS views,
  corrupt
FROM r
""",
    "csv_roundtrip": """
SELECT doc_id, sha256(text) AS text_sha256, CASE doc_id % 4 WHEN 0 THEN 'null' WHEN 1 THEN 'nan' WHEN 2 THEN '' ELSE ' "q", ' END AS word,
       CASE WHEN doc_id % 2 = 0 THEN sha256(' ' || text || chr(10) || ' ') END AS padded_sha256
FROM documents
""",
}
