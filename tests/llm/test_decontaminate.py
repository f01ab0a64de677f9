import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from reverbkit.llm import decontaminate as dc
from reverbkit.llm.queries import op11_decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def expected(text, items, length=10):
    """(n_words, hit words, item ids) by trying every window at every place."""
    ws, hit, named = words(text), set(), set()
    for i, t in items:
        iw = words(t)
        k = min(length, len(iw))
        windows = {tuple(iw[a : a + k]) for a in range(len(iw) - k + 1)} if k else set()
        for a in range(len(ws) - k + 1):
            if tuple(ws[a : a + k]) in windows:
                hit |= set(range(a, a + k))
                named.add(i)
    return len(ws), hit, sorted({str(i) for i in named if i is not None})


def mixed_rows(seed=5):
    r = random.Random(seed)
    vocab = ["alpha", "Beta", "gamma7", "Été", "日本", "x", "Y2", "delta", "omega", "Straße"]
    joint = [" ", "\n", ", ", "-", "\u007f", " _ "]

    def text(n):
        return "".join(r.choice(vocab) + r.choice(joint) for _ in range(n))

    items = [(k, text(r.choice([1, 3, 9, 10, 11, 25]) if k % 3 else 14)) for k in range(12)]
    items += [(20, ""), (21, None), (22, "... !!"), (None, text(12)), (23, items[0][1]), (23, text(10)), (24, "é")]
    docs = [text(r.randrange(0, 60)) for _ in range(40)]
    for k in range(30):
        source = items[k % 12][1]
        docs.append(text(r.randrange(5)) + source.upper().replace("É", "é") + text(r.randrange(5)))
        docs.append(text(3) + " ".join(source.split()[1:]) + " " + source)
    docs += ["", None, docs[45], docs[45], "alpha" * 50_000, text(200_000) + items[3][1], "\x00", "é"]
    return docs, items


@pytest.fixture(scope="module")
def frames(spark):
    docs, items = mixed_rows()
    d = spark.createDataFrame(list(enumerate(docs)) + [(None, docs[50]), (3, docs[51])], "doc_id long, text string").withColumn("n_hit", F.lit("x")).withColumn("row", F.lit(1)).withColumn("items", F.lit(2))
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(9)).withColumn("item", F.lit("q"))
    return d, i, docs, items


@pytest.mark.parametrize("most", [dc.MAX_ITEM_BYTES, 0])
def test_same_as_brute_force_by_set_and_by_join(frames, most):
    d, i, docs, items = frames
    got = dc.find_overlaps(d, i, max_item_bytes=most).collect()
    assert len(got) == len(docs) + 2
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append(r)
    for k, t in [*enumerate(docs), (None, docs[50])]:
        if k == 3:
            continue  # two rows share this id
        (r,) = by_id[k]
        n, hit, named = expected(t, items)
        assert (r["n_words"], r["n_hit"], r["items"]) == (n, len(hit), named), k
        spans = [range(s["start"], s["end"]) for s in r["spans"]]
        assert sorted(x for s in spans for x in s) == sorted(hit)
        assert all(a.stop < b.start for a, b in zip(spans, spans[1:], strict=False))
    assert sorted(r["n_hit"] for r in by_id[3]) == sorted(len(expected(t, items)[1]) for t in (docs[3], docs[51]))


@pytest.mark.parametrize("most", [dc.MAX_ITEM_BYTES, 0])
def test_spans_and_documents_are_removed(frames, most):
    d, i, docs, items = frames
    kept = dc.decontaminate(d, i, max_item_bytes=most)
    assert kept.columns == d.columns
    rows = {r["doc_id"]: r["text"] for r in kept.collect() if r["doc_id"] not in (None, 3)}
    for k, t in enumerate(docs):
        if k != 3:
            n, hit, _ = expected(t, items)
            assert words(rows[k]) == [w for p, w in enumerate(words(t)) if p not in hit], k
            assert hit or rows[k] == t
    clean = {r["doc_id"] for r in dc.decontaminate(d, i, remove="documents", max_item_bytes=most).collect()}
    assert clean - {None, 3} == {k for k, t in enumerate(docs) if not expected(t, items)[1]} - {3}
    with pytest.raises(ValueError):
        dc.decontaminate(d, i, remove="words")


@pytest.mark.parametrize("most", [dc.MAX_ITEM_BYTES, 0])
def test_empty_tables(frames, most):
    d, i, docs, _ = frames
    assert dc.find_overlaps(d.limit(0), i, max_item_bytes=most).collect() == []
    assert {r["n_hit"] for r in dc.find_overlaps(d, i.where("false"), max_item_bytes=most).collect()} == {0}


def test_words_that_share_their_first_bytes_are_told_apart(spark):
    long_a, long_b = "a" * 100 + "b", "a" * 100 + "c"
    d = spark.createDataFrame([(1, long_a), (2, long_b)], "doc_id long, text string")
    i = spark.createDataFrame([(1, long_b)], "item_id long, text string")
    assert {r["doc_id"]: r["n_hit"] for r in dc.find_overlaps(d, i).collect()} == {1: 0, 2: 1}


def test_a_window_does_not_reach_into_the_next_text(spark):
    ws = [f"w{k}" for k in range(10)]
    d = spark.createDataFrame([(1, " ".join(ws[:5])), (2, " ".join(ws[5:])), (3, " ".join(ws))], "doc_id long, text string").coalesce(1)
    i = spark.createDataFrame([(1, " ".join(ws))], "item_id long, text string")
    assert {r["doc_id"]: r["n_hit"] for r in dc.find_overlaps(d, i).collect()} == {1: 0, 2: 0, 3: 10}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    found = {r["doc_id"]: r for r in op11_decontaminate(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    windows = {}
    for i, t in items:
        ws = words(t)
        for a in range(max(1, len(ws) - 9)):
            windows.setdefault(" ".join(ws[a : a + 10]), set()).add(str(i))
    assert len(found) == len(docs) and any(r["contaminated"] for r in found.values())
    for r in docs:
        ws = words(r["text"])
        at = [a for a in range(len(ws)) if " ".join(ws[a : a + 10]) in windows and len(ws) - a >= 10]
        hit = {p for a in at for p in range(a, a + 10)}
        named = sorted({i for a in at for i in windows[" ".join(ws[a : a + 10])]})
        f = found[r["doc_id"]]
        assert (f["n_words"], f["n_hit"], f["n_items"], f["contaminated"]) == (len(ws), len(hit), len(named), bool(hit))
        assert f["items_sha256"] == hashlib.sha256(",".join(named).encode()).hexdigest()
