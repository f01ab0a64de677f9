import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reverbkit.llm import spelling
from reverbkit.llm.queries import op12_spelling_variants

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def counted(rows, least=7, drop=31):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % drop == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += len(run) >= least
    return {w: k for w, k in n.items() if k >= 2}


def expected(n, ratio=10):
    out, by_length = {}, {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    form = {}
    for w in n:
        around = [x for k in (-1, 0, 1) for x in by_length.get(len(w) + k, ()) if near(w, x)]
        best = min(around, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
        out[w] = [n[w], len(around)]
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, *out[w], n.get(form[w]))
    return out


def got(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def vocabulary(seed, alphabet, lengths, size):
    """Random words and what one or two edits make of them."""
    r, words = random.Random(seed), {}
    for _ in range(size):
        w = "".join(r.choice(alphabet) for _ in range(r.choice(lengths)))
        for _ in range(r.randrange(4)):
            words[w] = r.choice([2, 3, 30, 31, 400, 5000])
            k, x = r.randrange(len(w) + 1), r.choice(alphabet)
            w = r.choice([w[:k] + x + w[k:], w[:k] + w[k + 1 :] or x, w[:k] + x + w[k + 1 :]])
    return words


@pytest.mark.parametrize(
    ("alphabet", "lengths", "t"),
    [("ab", range(1, 9), 2), ("abcé", range(5, 12), 3), ("abcdefñ日😀", range(7, 14), 8), ("aàbcdefghij", range(7, 20), 64), ("ab", [62, 63, 64, 65, 66, 67, 200], 2)],
)
def test_same_as_brute_force(spark, alphabet, lengths, t):
    n = vocabulary(3, alphabet, list(lengths), 400)
    df = spark.createDataFrame(list(n.items()), "word string, n long").repartition(5)
    assert got(spelling.variants(df, t=t)) == expected(n)


def test_hot_words_are_met_through_residues(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HOT", 0)  # every word's lists are too long
    n = vocabulary(4, "abc", [7, 8, 9], 200)
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    assert got(spelling.variants(df, t=1)) == expected(n)


def test_dictionary_stays_within_its_bound(spark):
    n = vocabulary(5, "abcdefgh", list(range(7, 12)), 2000)
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    known = spelling.learn(df, t=1, max_grams=200)
    assert known.t > 1 and sum(len(k) for k, _ in known.levels.values()) <= 200
    whole = spelling.learn(df, t=1)
    grams = Counter(w[k : k + 2] for w in (x + "\0" for x in n) for k in range(len(w) - 1))
    assert sorted(whole.levels[2][1].tolist()) == sorted(c for c in grams.values() if c > 0)


def test_whole_texts(spark):
    r = random.Random(8)
    base = ["Lighthouse", "lighthousé", "ÉTÉÊËÈÀÇ", "wonderful", "wonderfull", "wonderfuly", "brightness", "rightness"]
    rows = [(i, " ".join(r.choice(base) + r.choice([" ", "1", "×日 ", "\n"]) for _ in range(r.randrange(60)))) for i in range(150)]
    rows += [(None, "lighthouse wonderful wonderfil wonderfil"), (5, None), (6, ""), (7, rows[7][1]), (7, rows[7][1]), (900, "wonderful " * 2000 + "a" * 70_000), (901, "a" * 70_000 + " wonderfiil")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("x")).withColumn("word", F.lit("y")).withColumn("key", F.lit(1))
    assert got(spelling.spelling_variants(df)) == expected(counted(rows))
    assert any(f for f, *_ in got(spelling.spelling_variants(df)).values())


def test_a_text_longer_than_a_piece(spark, monkeypatch):
    text = ("straße maßstab Fußgänger " * 300_000)[:-1]
    assert len(text.encode()) > spelling.PIECE
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert {r["word"]: r["n"] for r in spelling.corpus_words(df).collect()} == counted([(1, text)])


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert got(spelling.spelling_variants(docs)) == {}
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([], "word string, n long"), ratio=1)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(op12_spelling_variants(spark, sf)) == expected(counted(rows))
