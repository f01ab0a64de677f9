"""Substring dedup by level-wise doubling.

A window is ``length`` consecutive words of one document. Words covered by a
window that also starts in a document with a smaller id are removed. Windows
are found level by level, and only what is repeated at one level is extended to
the next:

1. Windows of half the length (7 of 13 words, rounded up). Of the half windows
   inside a full one, only that with the smallest hash is looked at: equal full
   windows choose the same one, so this loses nothing and about a quarter of
   all positions remain. Their hashes are counted over all documents.
2. Full windows (twice the half, less one word when the length is odd) around
   half windows that at least two documents have. The smallest document of each
   is found; the windows of all other documents are returned to them.

Longer windows consist of full ones and can't change which words go, so the
doubling ends there. Copies of a whole text are settled beforehand: they keep nothing, and
only the smallest document of each text goes through level 2. Counts are partially aggregated and the way back is a join that Spark
can split, so a line that a third of all documents share is no hot spot.

Windows are compared by 64-bit hashes of 64-bit word hashes, which numpy takes for
all words of a slice of texts at once.

Defined results: null and empty texts have no words and lose nothing; a text
with fewer words than a window loses nothing; a window repeated only within one
document is kept; rows that share a doc_id are judged one by one against
smaller ids, so exact repeats of a row all stay; a null doc_id is neither
smaller nor larger than another id: such rows lose nothing and make others lose
nothing. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reverbkit.llm.common import cut_lineage, slices, texts

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE, _BACK = np.uint64(0xA0761D6478BD642B), np.uint64(pow(0xA0761D6478BD642B, -1, 1 << 64))
_GAPS = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
SLICE_BYTES = 1 << 18  # of text hashed at a time, but at least one text


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift in (32, 29, 32):
        x = (x ^ (x >> np.uint64(shift))) * _MIX
    return x ^ (x >> np.uint64(32))


_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64))  # a number for each byte


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts, words of each text). A word's hash is a
    polynomial in the numbers of its bytes, taken from sums over all bytes at once."""
    column = texts.cast(pa.large_string())
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, np.uint64), np.zeros(len(column), np.int64)
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    found, counts, k = [], [], 0
    while k < len(column):
        to = max(int(np.searchsorted(ends, ends[k] + SLICE_BYTES, "right")) - 1, k + 1)
        data, at = np.frombuffer(column.buffers()[2], np.uint8)[ends[k] : ends[to]], ends[k : to + 1] - ends[k]
        gap = np.concatenate((_GAPS[data], [True]))
        first = np.zeros(len(data) + 1, bool)  # of a text
        first[at] = True
        start = ~gap
        start[1:] &= gap[:-1] | first[1:]
        stop = np.flatnonzero(np.concatenate((~gap[:-1] & (gap[1:] | first[1:]), [False]))) + 1
        start = np.flatnonzero(start)
        powers = np.full(len(data) + 1, _BASE, np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * powers[:-1], out=sums[1:])
        back = np.full(len(data) + 1, _BACK, np.uint64)
        back[0] = 1
        np.multiply.accumulate(back, out=back)
        found.append(_mixed((sums[stop] - sums[start]) * back[start]))
        counts.append(np.diff(np.searchsorted(start, at)))
        k = to
    return np.concatenate(found), np.concatenate(counts)


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each window of ``length`` word hashes."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out *= _MIX
        out += hashes[k : k + n]
        out ^= out >> np.uint64(31)
    return out


def anchors(hashes: np.ndarray, length: int) -> np.ndarray:
    """For each window of ``length`` words the smallest hash of its half windows."""
    half = (length + 1) // 2
    h = window_hashes(hashes, half)
    span = length - half + 1
    if len(h) < span:
        return np.zeros(0, np.uint64)
    low, width = h, 1
    while 2 * width <= span:
        low, width = np.minimum(low[:-width], low[width:]), 2 * width
    return np.minimum(low[: len(h) - span + 1], low[span - width :][: len(h) - span + 1])


def _table(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _windows(of: np.ndarray, hashes: np.ndarray, length: int, kind: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, hash) of the windows that lie in one text; ``of`` is the text of
    each word and ``kind`` hashes the windows over all words."""
    h = kind(hashes, length)
    at = np.flatnonzero(of[: len(h)] == of[length - 1 :][: len(h)])
    return of[at], at, h[at]


def _distinct(of: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, hash)."""
    order = np.lexsort((h, of))
    of, h = of[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (of[1:] != of[:-1]) | (h[1:] != h[:-1])
    return of[new], h[new]


def _held(of: np.ndarray, h: np.ndarray, lists: pa.ListArray) -> np.ndarray:
    """Whether the list of a hash's text holds it."""
    known = lists.flatten().to_numpy().view(np.uint64)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    ends = np.concatenate(([0], np.cumsum(sizes)))
    known = known[np.lexsort((known, np.repeat(np.arange(len(sizes)), sizes)))]
    held, edges = np.zeros(len(h), bool), np.searchsorted(of, np.arange(len(sizes) + 1))
    for k in np.flatnonzero(sizes):
        own, asked = known[ends[k] : ends[k + 1]], h[edges[k] : edges[k + 1]]
        held[edges[k] : edges[k + 1]] = own[np.minimum(np.searchsorted(own, asked), len(own) - 1)] == asked
    return held


def _rows(ids: pa.Array, of: np.ndarray, values: np.ndarray, name: str) -> pa.RecordBatch:
    """One row (doc_id, value) for each value; ``of`` is its document's place in ``ids``."""
    return _table({"doc_id": ids.take(pa.array(of)), name: pa.array(values.view(np.int64))})


def remove_repeats(docs: DataFrame, length: int = 13, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """(doc_id, text, n_words, n_removed, kept_sha256) for every row of ``docs``.
    ``text`` is the input's where nothing was removed (null: empty), else the
    kept words joined by one space. ``carry`` adds the struct ``row`` with all
    columns of the input row but its text."""
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    whole, rest = rows, []
    if carry:
        rest = [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row")]
        whole = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *rest)
    digest = F.md5(F.col("text").cast("binary"))

    def half_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b):
                hashes, counts = word_hashes(part["text"])
                of, _, h = _windows(np.repeat(np.arange(len(counts)), counts), hashes, length, anchors)
                new = np.ones(len(h), bool)  # neighbouring windows mostly share theirs
                new[1:] = (of[1:] != of[:-1]) | (h[1:] != h[:-1])
                yield _rows(part["doc_id"], *_distinct(of[new], h[new]), "h")

    asked = rows.where(F.col("doc_id").isNotNull())
    halves = asked.select("doc_id", "text").mapInArrow(half_windows, f"doc_id {kind}, h long")
    repeated = halves.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    own = cut_lineage(halves.join(repeated, "h").groupBy("doc_id").agg(F.collect_set("h").alias("halves")), "halves")
    digests = cut_lineage(asked.select("doc_id", digest.alias("digest")), "digests")
    first = digests.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    copies = cut_lineage(
        digests.join(first, "digest").where("doc_id > first").groupBy("doc_id").agg(F.collect_set("digest").alias("copies")), "copies"
    )
    is_copy = F.coalesce(F.array_contains("copies", digest), F.lit(False))

    def full_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b):
                hashes, counts = word_hashes(part["text"])
                of, at, h = _windows(np.repeat(np.arange(len(counts)), counts), hashes, length, anchors)
                keep = _held(of, h, part["halves"])
                full = window_hashes(hashes, length)[at[keep]]
                yield _rows(part["doc_id"], *_distinct(of[keep], full), "h")

    once = asked.join(own, "doc_id").join(copies, "doc_id", "left").where(~is_copy).select("doc_id", "text", "halves")
    fulls = cut_lineage(once.mapInArrow(full_windows, f"doc_id {kind}, h long"), "windows")
    least = fulls.groupBy("h").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("h", "first")
    gone = fulls.join(least, "h").where("doc_id > first").groupBy("doc_id").agg(F.collect_set("h").alias("gone"))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b):
                copies_here = part["copy"].to_numpy(zero_copy_only=False)
                some = np.flatnonzero(part["gone"].is_valid().to_numpy(zero_copy_only=False) & ~copies_here)
                asked = part.take(pa.array(some))
                hashes, counts = word_hashes(asked["text"])
                of, at, h = _windows(np.repeat(np.arange(len(counts)), counts), hashes, length, window_hashes)
                at = at[_held(of, h, asked["gone"])]
                edge = np.zeros(len(hashes) + 1, np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + length, -1)
                stay, ends = np.cumsum(edge[:-1]) == 0, np.concatenate(([0], np.cumsum(counts)))
                stays = {int(k): stay[ends[i] : ends[i + 1]].tolist() for i, k in enumerate(some)}
                out, n_words, n_removed, shas = [], [], [], []
                for k, (t, copy) in enumerate(zip(part["text"].to_pylist(), copies_here.tolist(), strict=True)):
                    ws = words(t)
                    left = ws
                    if copy and len(ws) >= length:
                        left = []
                    elif k in stays:
                        left = list(compress(ws, stays[k]))
                    joined = b" ".join(left)
                    out.append(t if len(left) == len(ws) else joined.decode("utf-8", "surrogatepass"))
                    n_words.append(len(ws))
                    n_removed.append(len(ws) - len(left))
                    shas.append(hashlib.sha256(joined).hexdigest())
                yield _table({"doc_id": part["doc_id"], "text": pa.array(out, pa.string()), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(shas, pa.string())} | ({"row": part["row"]} if carry else {}))

    told = (
        whole.join(copies, "doc_id", "left")
        .join(gone, "doc_id", "left")
        .select("doc_id", "text", is_copy.alias("copy"), "gone", *(["row"] if carry else []))
    )
    schema = T.StructType.fromDDL(f"doc_id {kind}, text string, n_words long, n_removed long, kept_sha256 string")
    return told.mapInArrow(kept, schema.add(told.schema["row"]) if carry else schema)
