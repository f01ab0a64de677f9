"""Video records as JSON text.

The reference reads a record with ``dict.get(key, default)``: the default stands in
for an absent key only, and a JSON null stays null. A typed JSON reader gives null
for both; ``VARIANT`` keeps them apart: the value of an absent key is SQL NULL, that of
a JSON null is a variant that ``is_variant_null``.

Text that is no JSON object is a corrupt record: its fields are null, its text goes
to ``corrupt_record``, and ``split_corrupt`` routes such rows aside. A value of
another type than the field's is null. Extra keys are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The fields of a record, their types and the defaults of absent keys.
FIELDS = {
    "title": ("string", "'No Title'"),
    "channel_name": ("string", "'Unknown Channel'"),
    "upload_date": ("string", "'Unknown Date'"),
    "tags": ("array<string>", "array()"),
    "views": ("bigint", "0"),
    "likes": ("bigint", "0"),
    "comment_count": ("bigint", "0"),
    "subscriber_count": ("bigint", "0"),
    "transcript": ("string", "''"),
    "comments": ("array<string>", "array()"),
}


def _field(name: str) -> Column:
    kind, default = FIELDS[name]
    return F.expr(
        f"case when not _object then cast(null as {kind}) when variant_get(_record, '$.{name}', 'variant') is null then cast({default} as {kind})"
        f" else try_variant_get(_record, '$.{name}', '{kind}') end"
    ).alias(name)


def video_fields(rows: DataFrame, json_col: str, keep: list[str] | None = None, fields: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``rows``, the ``fields`` (default: all) of the records in
    ``json_col``, and ``corrupt_record``."""
    keep = keep or []
    parsed = rows.select(*keep, F.col(json_col).alias("_text"), F.try_parse_json(F.col(json_col)).alias("_record"))
    known = parsed.withColumn("_object", F.coalesce(F.schema_of_variant("_record").startswith("OBJECT"), F.lit(False)))
    corrupt = F.when(~F.col("_object"), F.coalesce("_text", F.lit(""))).alias("corrupt_record")
    return known.select(*keep, *[_field(f) for f in fields or FIELDS], corrupt)


def read_video_records(spark: SparkSession, path: str) -> DataFrame:
    """S1 + S7: one record per file, with the defaults of absent keys and the file's hash
    as ``video_id``."""
    files = spark.read.text(path, wholetext=True).select("value", F.xxhash64(F.input_file_name()).alias("video_id"))
    return video_fields(files, "value", ["video_id"])


def split_corrupt(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The good records, and the corrupt ones."""
    good = records.where("corrupt_record is null").drop("corrupt_record")
    return good, records.where("corrupt_record is not null")
