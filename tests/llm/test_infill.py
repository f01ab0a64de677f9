import hashlib

import pytest
from pyspark.sql import functions as F

from reverbkit.llm import infill
from reverbkit.llm.queries import op13_fill_in_middle

LONG = "añ😀\n日 $1\\Q" * 60_000  # 600 000 code points, four lengths in UTF-8


def expected(i, text, plain=10, spm=20):
    """The contract, by slicing."""
    text = text or ""
    g = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(g[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not n or any(x in text for x in infill.SENTINELS) or h[2] % 100 >= 100 - plain:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_cuts_forms_and_round_trip(spark):
    texts = ["", None, "a", "ab", "😀", "x <P> y", "<S", "S> <", "$1 \\1 ${a}", "a\r\nb c", "é" * 1024, "日" * 1025, "q" * 5000, "<M>", LONG]
    rows = [(i, texts[i % len(texts)]) for i in range(300)] + [(None, "no id"), (3, "ab"), (3, "ab"), (7, LONG + "!")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash")).withColumn("output", F.lit(1)).withColumn("h", F.lit(0))
    made = infill.fill_in_middle(df)
    got = made.withColumn("back", infill.restore(F.col("output"), F.col("form"))).collect()
    assert sorted((str(r["doc_id"]), r["n"], r["form"], str(r["prefix_chars"]), str(r["middle_chars"]), r["output"], r["back"]) for r in got) == sorted(
        (str(i), *(str(x) if k in (2, 3) else x for k, x in enumerate(expected(i, t))), t or "") for i, t in rows
    )
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_five_million_characters(spark):
    df = spark.createDataFrame([(1, "ab😀\n日")], "doc_id long, text string").select("doc_id", F.repeat("text", 1_000_000).alias("text"))
    made = infill.fill_in_middle(df)
    same = made.join(df, "doc_id").select("n", "form", (infill.restore(F.col("output"), F.col("form")) == F.col("text")).alias("same")).first()
    assert same["n"] == 5_000_000 and same["same"]


def test_units_shares_and_other_sentinels(spark):
    df = spark.createDataFrame([(i, "one two  three\nfour " * 3) for i in range(40)], "doc_id long, text string")
    marks = ("$a", "\\b", "[c]")
    made = infill.fill_in_middle(df, plain_percent=0, spm_percent=50, sentinels=marks, unit=r"(?:\S+\s*)").withColumn("back", infill.restore(F.col("output"), F.col("form"), marks)).collect()
    assert {r["n"] for r in made} == {12} and {r["form"] for r in made} == {"psm", "spm"}
    assert all(r["back"] == "one two  three\nfour " * 3 for r in made)
    assert all(r["output"].replace("$a", "").replace("\\b", "").replace("[c]", "").split() for r in made)


def test_empty_table_and_plan(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert infill.fill_in_middle(none).collect() == []
    plan = infill.fill_in_middle(none)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    # each text's units are counted once
    assert plan.count("regexp_extract_all") == 2


def test_query(spark):
    rows = op13_fill_in_middle(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {(r["doc_id"], *expected(r["doc_id"], r["text"])[:4], sha(expected(r["doc_id"], r["text"])[4]), sha(r["text"] or "")) for r in docs}
    assert {tuple(r) for r in rows} == want and len(rows) == len(docs)


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 4096])
def test_count_units(spark, n):
    assert spark.range(1).select(infill.count_units(F.repeat(F.lit("é"), n)).alias("n")).first()["n"] == n
