"""Sources and sinks.

* video records: one JSON object per file (multi-line), explicit schema,
  ``PERMISSIVE`` mode with a ``_corrupt_record`` column for bad files;
* CSV with header / quoted multi-line fields, explicit schema;
* parquet (preferred inside the engine);
* sinks overwrite, optionally partitioned;
* ``require_columns`` is a plan-time check (no job runs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VIDEO_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("comment_count", T.LongType()),
    T.StructField("views", T.LongType()),
    T.StructField("upload_date", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("likes", T.LongType()),
    T.StructField("channel_name", T.StringType()),
    T.StructField("subscriber_count", T.LongType()),
    T.StructField("transcript", T.StringType()),
    T.StructField("comments", T.ArrayType(T.StringType())),
    T.StructField("_corrupt_record", T.StringType()),
])

LABELLED_SCHEMA = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("label", T.IntegerType()),
])


class MissingColumns(ValueError):
    pass


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """Fail at plan time unless every required column is present."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumns(f"input must contain columns {required}; missing {missing}")
    return df


def read_videos(spark: SparkSession, path: str) -> DataFrame:
    """Video records, one JSON object per file; ``video_id`` is the
    source file path's hash (stable, no driver-side numbering)."""
    df = (
        spark.read.schema(VIDEO_SCHEMA)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path)
    )
    return df.withColumn("video_id", F.xxhash64(F.input_file_name(), F.coalesce("url", F.lit(""))))


def write_videos(df: DataFrame, path: str) -> None:
    """JSON records (UTF-8, non-ASCII kept as is)."""
    cols = [f.name for f in VIDEO_SCHEMA.fields if f.name != "_corrupt_record" and f.name in df.columns]
    df.select(*cols).write.mode("overwrite").json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S3: header + quoted, multi-line fields, explicit schema. No null
    sentinels: a comment reading "null" or "nan" stays text."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", None)
        .csv(path)
    )


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Overwrite sink (parquet by default, CSV with header on request)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        # the writer would trim texts; quotes inside are doubled
        w = w.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        w.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    else:
        w.format(fmt).save(path)


def read_labelled(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Labelled text (text, label)."""
    if fmt == "csv":
        return read_csv(spark, path, LABELLED_SCHEMA)
    return require_columns(spark.read.format(fmt).load(path), ["text", "label"])


def with_defaults(videos: DataFrame) -> DataFrame:
    """The report's defaults for missing fields. Spark cannot tell an
    absent key from a JSON null; both take the default."""
    return videos.select(
        "*",
        F.coalesce("title", F.lit("No Title")).alias("title_or_default"),
        F.coalesce("channel_name", F.lit("Unknown Channel")).alias("channel_or_default"),
        F.coalesce("upload_date", F.lit("Unknown Date")).alias("upload_date_or_default"),
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags_or_default"),
    )
