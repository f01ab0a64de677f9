"""Absent keys, JSON nulls, wrong types, corrupt records; S3 / S4 CSV."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from reverbkit.sources.io import read_csv, write_table
from reverbkit.sources.records import FIELDS, read_video_records, split_corrupt, video_fields


def test_absent_is_not_null(spark):
    texts = [
        "{}",
        json.dumps(dict.fromkeys(FIELDS)),
        json.dumps({"title": "t", "tags": ["x", None], "views": 7, "likes": "8", "comments": "no list", "extra": {"title": 1}}),
        '{"title": "cut off',
        "[1, 2]",
        "",
        None,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, j string").withColumn("title", F.lit("clash"))
    rows = {r["id"]: r for r in video_fields(df, "j", ["id"]).collect()}
    r = rows[0]
    assert (r["title"], r["channel_name"], r["upload_date"], r["tags"], r["views"], r["transcript"], r["comments"]) == ("No Title", "Unknown Channel", "Unknown Date", [], 0, "", [])
    assert all(rows[1][f] is None for f in FIELDS) and rows[1]["corrupt_record"] is None
    assert (rows[2]["title"], rows[2]["tags"], rows[2]["views"], rows[2]["likes"], rows[2]["comments"]) == ("t", ["x", None], 7, 8, None)
    assert rows[2]["channel_name"] == "Unknown Channel"
    for k in (3, 4, 5, 6):
        assert all(rows[k][f] is None for f in FIELDS) and rows[k]["corrupt_record"] == (texts[k] or "")


def test_files_and_routing(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"title": "é 😀", "views": None}, indent=1, ensure_ascii=False))
    (tmp_path / "b.json").write_text('{"title": ')
    good, bad = split_corrupt(read_video_records(spark, str(tmp_path)))
    (r,) = good.collect()
    assert (r["title"], r["views"], r["likes"]) == ("é 😀", None, 0) and "corrupt_record" not in good.columns
    assert [x["corrupt_record"] for x in bad.collect()] == ['{"title": ']


def test_csv_keeps_every_text(spark, tmp_path):
    texts = ["null", "nan", "NaN", "", None, " a ", "x,y", 'say "hi"', "line\nend", "cr\r\nlf", "tab\t", "é 日 😀", '"', "\\", '\\"', "a" * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    write_table(df, str(tmp_path / "c"), "csv")
    again = read_csv(spark, str(tmp_path / "c"), T.StructType().add("id", "integer").add("t", "string"))
    assert {r["id"]: r["t"] for r in again.collect()} == dict(enumerate(texts))
