"""F1-F11, W1, S15 on literal rows (FIXTURES.md section 5)."""

import random

import pytest
from pyspark.sql import functions as F

from reverbkit.functions.text import clean_comment, clean_transcript, demojize, expand_slang
from reverbkit.operators import chunks as CH

COMMENTS = [
    ("@bob thanks", None),
    ("  @bob thanks", None),
    ("see http://x.y/z U R gr8!!", "see you are great"),
    ("éu u", "u you"),
    ("ain't no cap", "is not no lie"),
    ("ain't ain't", "is not is not"),
    ("0:10 nice, don't", "0:10 nice dont"),
    ("\U0001F525", ":amazing:"),
    ("so proud \U0001F3C6\U0001F389", "so proud :trophy::partypopper:"),
    ("congrats \U0001F1EE\U0001F1F3", "congrats :india:"),
    ("日本", None),
    ("", None),
    (None, None),
    ("lol\r\nthx u", "laugh out loud thanks you"),
    ("l.o.l", "lol"),
    ("www.example.com only", "only"),
]


def test_clean_comment_vectors(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(COMMENTS)], "i int, t string")
    got = {r.i: r.c for r in df.select("i", clean_comment(F.col("t")).alias("c")).collect()}
    for i, (_, want) in enumerate(COMMENTS):
        assert got[i] == want, COMMENTS[i]


def test_cleaned_comments_alphabet(spark):
    from reverbkit.plans.text_queries import cleaned_comments

    bad = cleaned_comments(spark, "/root/testdata/sf0.001").where(~F.col("comment").rlike("^[a-z0-9 :]+$"))
    assert bad.count() == 0


def test_slang_one_pass(spark):
    df = spark.createDataFrame([("u r the best tbh, idk lol",), ("ur bro's bday",), ("capital cap",)], "t string")
    got = [r[0] for r in df.select(expand_slang(F.col("t"))).collect()]
    assert got == ["you are the best to be honest, i don't know laugh out loud",
                   "your brother's birthday", "capital lie"]


def test_demojize_unknown_passes(spark):
    df = spark.createDataFrame([("a\U0001F525b",), ("x☺️y",)], "t string")
    got = [r[0] for r in df.select(demojize(F.col("t"))).collect()]
    assert got[0] == "a:fire:b"
    assert got[1].startswith("x:") and got[1].endswith(":y")


def test_clean_transcript(spark):
    df = spark.createDataFrame([("[Music] he won\n2.5 million & left",), (None,), ("[a\nb] x",)], "t string")
    got = [r[0] for r in df.select(clean_transcript(F.col("t"))).collect()]
    assert got == ["he won 2.5 million  left", "", "a b x"]


@pytest.mark.parametrize("n,expected", [(0, 0), (1, 1), (48, 1), (49, 2), (50, 2), (64, 2), (65, 2), (112, 3), (568, 12)])
def test_chunk_counts(spark, n, expected):
    text = " ".join(f"w{i}" for i in range(n))
    df = spark.createDataFrame([(1, text)], "video_id long, t string")
    rows = CH.chunk_text(df, "video_id", "t").orderBy("chunk_index").collect()
    assert len(rows) == expected
    if n == 568:
        assert len(rows[-1].chunk.split()) == 40
    if n == 50:
        assert [len(r.chunk.split()) for r in rows] == [50, 2]


def test_chunk_overlap_equal_size_rejected(spark):
    with pytest.raises(ValueError):
        CH.chunk_array(F.col("x"), 16, 16)


def test_segments_chunk_like_assembled_text(spark, monkeypatch):
    """Distributed chunking == chunking the assembled transcript."""
    monkeypatch.setattr(CH, "SEG_BUCKET", 3)
    rnd = random.Random(7)
    rows = []
    for vid in range(4):
        for seg in range(rnd.randint(0, 12)):
            n = rnd.randint(0, 40)
            rows.append((vid, seg, " ".join(rnd.choice(["a", "bb", "[x]", "c,", "d\n", "é"]) for _ in range(n))))
    segs = spark.createDataFrame(rows, "video_id long, seg_idx long, segment string")
    for size, overlap in [(64, 16), (5, 2), (7, 0)]:
        dist = CH.chunk_segments(segs, "video_id", "seg_idx", "segment", size, overlap)
        asm = CH.assemble_transcript(segs, "video_id", "seg_idx", "segment")
        direct = CH.chunk_text(asm, "video_id", "transcript", size, overlap)
        a = sorted(tuple(r) for r in dist.collect())
        b = sorted(tuple(r) for r in direct.collect())
        assert a == b


def test_assembly_order(spark):
    segs = spark.createDataFrame([(1, 2, "c"), (1, 0, "a"), (1, 1, "b")], "video_id long, seg_idx long, segment string")
    r = CH.assemble_transcript(segs).first()
    assert r.transcript == "a\nb\nc\n" and r.n_segments == 3


def test_emoji_names(spark):
    """Short names written by hand; what is no emoji stays."""
    cases = {
        "\U0001F44D\U0001F3FD ok": ":thumbs_up_medium_skin_tone: ok",
        "\U0001F1EF\U0001F1F5 hi \U0001F1EE\U0001F1F3\U0001F1FA\U0001F1F8": ":japan: hi :india::united_states:",
        "\u2B50\u23F0\U0001F7E2": ":star::alarm_clock::green_circle:",
        "\u2764\uFE0F\u200D\U0001F525 \u2764\uFE0F \u2764": ":heart_on_fire: :red_heart: :red_heart:",
        "\U0001F468\u200D\U0001F469\u200D\U0001F467": ":family_man_woman_girl:",
        "\U0001F469\U0001F3FB\u200D\U0001F4BB": ":woman_technologist_light_skin_tone:",
        "1\uFE0F\u20E3 n 12 #1 *": ":keycap_1: n 12 #1 *",
        "\U0001F601 \U0001F4AF \U0001F64C": ":beaming_face_with_smiling_eyes: :hundred_points: :raising_hands:",
        "\U0001F3F4\U000E0067\U000E0062\U000E0065\U000E006E\U000E0067\U000E007F": ":england:",
        "\U0001F3FD alone": ":medium_skin_tone: alone",
        "\U0001F525\u200D\U0001F3C6": ":fire:\u200d:trophy:",
        "\u2713 \u2605 \u2192 \U0001F1EF x\ny": "\u2713 \u2605 \u2192 \U0001F1EF x\ny",
        "": "",
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "t string")
    got = {r.t: r.d for r in df.select("t", demojize("t").alias("d")).collect()}
    assert got == cases | {None: None}


def test_sample_emoji_comments(spark):
    """The names as they stand in the published sample output."""
    df = spark.createDataFrame([("India now champion \U0001F3C6\U0001F3C6 \U0001F1EE\U0001F1F3 man \U0001F389",)], "t string")
    assert df.select(clean_comment("t")).first()[0] == "india now champion :trophy::trophy: :india: man :partypopper:"
