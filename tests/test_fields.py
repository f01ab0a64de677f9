"""S8-S14 parsing."""

from pyspark.sql import functions as F

from reverbkit.functions import fields as FX


def test_subscribers(spark):
    df = spark.createDataFrame([("65.1K subscribers",), ("2.01M subscribers",), ("950 subscribers",),
                                ("1 subscriber",), ("1,234 subscribers",)], "t string")
    got = [r[0] for r in df.select(FX.subscriber_count(F.col("t"))).collect()]
    assert got == [65100, 2010000, 950, None, 1234]


def test_views_date_likes_counts(spark):
    df = spark.createDataFrame([("121,866 views 13 Dec 2024", "1,234 Comments", "like this video along with 3,478 other people"),
                                ("1.2 views Dec 13, 2024", "x", "no likes")], "info string, c string, l string")
    r = df.select(FX.views_from_info(F.col("info")).alias("v"), FX.upload_date(F.col("info")).alias("d"),
                  FX.upload_dt(FX.upload_date(F.col("info"))).alias("dt"),
                  FX.count_digits(F.col("c")).alias("c"), FX.likes_from_label(F.col("l")).alias("l")).collect()
    assert (r[0].v, r[0].d, str(r[0].dt), r[0].c, r[0].l) == (121866, "13 Dec 2024", "2024-12-13", 1234, 3478)
    assert (r[1].v, r[1].d, str(r[1].dt), r[1].c, r[1].l) == (None, "Dec 13, 2024", "2024-12-13", None, None)


def test_page_fields(spark):
    html = ('<html lang="en"><head><title>T &amp; x</title></head><body><nav><a href="/a">#alpha</a>'
            '<a href="/b">##beta</a></nav></body></html>')
    df = spark.createDataFrame([(html,), ("<html><body>none</body></html>",)], "h string")
    r = df.select(FX.page_title(F.col("h")).alias("t"), FX.page_lang(F.col("h")).alias("l"),
                  FX.page_tags(F.col("h")).alias("g")).collect()
    assert (r[0].t, r[0].l, r[0].g) == ("T & x", "en", ["alpha", "beta"])
    assert (r[1].t, r[1].l, r[1].g) == (None, None, ["No tags found"])


def test_rendered_title_and_tags(spark):
    html = [
        ("<TITLE lang='en'> A &amp; B &#39;x&#x27; &lt;i&gt; &amp;lt; &#128512; &#99999999; &quot; </TITLE>", """A & B 'x' <i> &lt; \U0001f600 &#99999999; \"""", ["No tags found"]),
        ("<title></title><nav class='t'><ul><a href='/a' id=1> #<b>R&amp;D</b> </a><A>two</A></ul></nav>", None, ["R&D", "two"]),
    ]
    from reverbkit.functions.fields import page_tags, page_title

    df = spark.createDataFrame([(h,) for h, _, _ in html], "html string")
    rows = df.select(page_title(df["html"]).alias("t"), page_tags(df["html"]).alias("g")).collect()
    assert [(r["t"], r["g"]) for r in rows] == [(t, g) for _, t, g in html]
