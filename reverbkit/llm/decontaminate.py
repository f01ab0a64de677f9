"""Benchmark decontamination: texts that hold passages of test items.

A window is ``length`` consecutive normalised words of an item; an item of fewer
words is one window. The items' texts, if they fit ``MAX_ITEM_BYTES`` (measured
before anything is collected), become a hash set of their windows, broadcast to
the workers. A scan hashes all windows of every document with array operations
over the UTF-8 bytes, asks the set, and verifies each hit word by word. Beyond
the bound the set stays a table: the scan asks a bit table of fixed size and what
passes is joined with the items' windows on hash and words. Both ways
find the same windows.

Words: A-Z lower-cased, then runs of digits, a-z and everything above U+007F.

Defined results: null and empty texts have no words; an item without words has no
window. An item with a null id makes words hit, but has no id to list; items that
share an id count once. Repeated rows and rows with a null id are each judged for
themselves. Spans are judged on the input, not on what is left. An empty
table gives an empty result; without items nothing is hit. Other columns of the
input are kept by ``decontaminate`` and ignored by ``find_overlaps``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reverbkit.llm.common import cut_lineage

MAX_ITEM_BYTES = 8 << 20  # of items' text in the broadcast set
FILTER_BITS = 26  # the bit table of larger sets has 2^26 bits
SLICE_BYTES = 1 << 20  # of text handled at a time
BLOCK_BYTES = 1 << 18  # of text whose words are hashed at a time
HASHED_BYTES = 64  # of a word; words alike so far and of equal length are told apart by the verification
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)

#: The normalised byte of a word, 0 outside words.
CODES = np.arange(256, dtype=np.uint8)
CODES[:0x30] = CODES[0x3A:0x41] = CODES[0x5B:0x61] = CODES[0x7B:0x80] = 0
CODES[0x41:0x5B] += 32


def _powers(x: int, n: int) -> np.ndarray:
    out = np.full(n, x, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_UP, _DOWN = (_powers(x, BLOCK_BYTES + HASHED_BYTES) for x in (_BASE, pow(_BASE, -1, 1 << 64)))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _STEP
    return h ^ (h >> np.uint64(29))


_VALUES = _mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(_BASE))


class Words:
    """The normalised words of some texts, found in their joined UTF-8 bytes."""

    def __init__(self, texts: pa.Array) -> None:
        lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        stops = np.cumsum(lengths)
        self.texts = stops - lengths
        raw = np.frombuffer(b"".join(texts.cast(pa.binary()).to_pylist()), np.uint8)
        self.codes = CODES[raw]
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = self.codes != 0
        edge = np.zeros(len(raw) + 1, bool)
        edge[self.texts] = edge[-1] = True
        self.start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
        self.end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
        # empty texts share their start with the next one: the last of equal starts owns the word
        self.text = np.searchsorted(self.texts, self.start, "right") - 1
        self.count = np.bincount(self.text, minlength=len(lengths))
        self.first = np.cumsum(self.count) - self.count

    def hashes(self) -> np.ndarray:
        out, at, n = np.empty(len(self.start), np.uint64), 0, len(self.start)
        while at < n:
            base = int(self.start[at])
            to = int(np.searchsorted(self.start, base + BLOCK_BYTES))
            start, end = self.start[at:to] - base, np.minimum(self.end[at:to], self.start[at:to] + HASHED_BYTES) - base
            values = _VALUES[self.codes[base : base + int(end[-1])]]
            sums = np.zeros(len(values) + 1, np.uint64)
            np.cumsum(values * _UP[: len(values)], out=sums[1:])
            length = (self.end[at:to] - self.start[at:to]).astype(np.uint64)
            out[at:to] = _mixed((sums[end] - sums[start]) * _DOWN[start] + length)
            at = to
        return out

    def windows(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """The hash of the ``length`` words from each word on, whatever texts they are of."""
        n = len(hashes) - length + 1
        out = np.full(max(n, 0), length, np.uint64)
        for k in range(length if n > 0 else 0):
            out *= _STEP
            out += hashes[k : k + n]
        return _mixed(out)

    def whole(self, at: np.ndarray, length: int) -> np.ndarray:
        """Whether the windows from the words ``at`` on lie in one text."""
        return self.text[at] == self.text[at + length - 1]

    def spelled(self, at: int, length: int) -> bytes:
        lo = self.start[at : at + length].tolist()
        hi = self.end[at : at + length].tolist()
        return b" ".join([self.codes[a:b].tobytes() for a, b in zip(lo, hi, strict=True)])


class ItemSet:
    """The hash set of all items' windows, with the words to verify a hit."""

    def __init__(self, ids: list[str | None], texts: list[str], length: int) -> None:
        self.ids, self.words, self.known = ids, Words(pa.array(texts, pa.string())), {}
        w, h = self.words, self.words.hashes()
        size = np.minimum(w.count, length)[w.text] if len(h) else np.zeros(0, np.int64)
        self.by_length = {}
        for k in np.unique(size).tolist():
            at = np.flatnonzero(size == k)
            at = at[at + k <= len(h)]
            at = at[w.whole(at, k)]
            keys = w.windows(h, k)[at]
            order = np.argsort(keys, kind="stable")
            self.by_length[k] = keys[order], at[order], _bit_table(keys[order])

    def _meant(self, length: int, key: int) -> dict[bytes, frozenset[str]]:
        """The windows of a hash value: their words and the items they are in."""
        if (length, key) not in self.known:
            keys, at, _ = self.by_length[length]
            lo, hi = np.searchsorted(keys, np.uint64(key), "left"), np.searchsorted(keys, np.uint64(key), "right")
            found = defaultdict(set)
            for a in at[lo:hi].tolist():
                found[self.words.spelled(a, length)].add(self.ids[self.words.text[a]])
            self.known[length, key] = {k: frozenset(v) for k, v in found.items()}
        return self.known[length, key]

    def hits(self, w: Words) -> tuple[np.ndarray, np.ndarray, dict[int, set]]:
        """Verified windows: their first words, their lengths, and each text's items."""
        starts, lengths, items = [], [], defaultdict(set)
        h = w.hashes()
        for k, (keys, _, bits) in self.by_length.items():
            windows = w.windows(h, k)
            at = np.flatnonzero(_asked(bits, windows))
            at = at[w.whole(at, k)] if len(at) else at
            at = at[keys[np.minimum(np.searchsorted(keys, windows[at]), len(keys) - 1)] == windows[at]]
            for a, key in zip(at.tolist(), windows[at].tolist(), strict=True):
                of = self._meant(k, key).get(w.spelled(a, k))
                if of is not None:
                    starts.append(a)
                    lengths.append(k)
                    items[int(w.text[a])] |= of
        return np.array(starts, np.int64), np.array(lengths, np.int64), items


def _bit_table(keys: np.ndarray, bits: int = 20) -> np.ndarray:
    table = np.zeros(1 << bits, bool)
    table[(keys >> np.uint64(64 - bits)).astype(np.int64)] = True
    return table


def _asked(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return table[(keys >> np.uint64(64 - len(table).bit_length() + 1)).astype(np.int64)]


def _slices(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    ends, at = np.cumsum(pc.binary_length(b["text"]).to_numpy(zero_copy_only=False).astype(np.int64)), 0
    while at < b.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES)))
        yield b.slice(at, to - at)
        at = to


def _told(part: pa.RecordBatch, w: Words, starts: np.ndarray, lengths: np.ndarray, items: dict[int, set], carry: bool) -> pa.RecordBatch:
    """A slice's result rows from its verified windows."""
    n_texts, n = part.num_rows, len(w.start)
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, starts + lengths, -1)
    hit = np.cumsum(depth)[:n] > 0
    other = np.ones(n, bool)
    other[1:] = w.text[1:] != w.text[:-1]
    open_, close = np.ones(n, bool), np.ones(n, bool)
    open_[1:] = ~hit[:-1] | other[1:]
    close[:-1] = ~hit[1:] | other[1:]
    lo, hi = np.flatnonzero(hit & open_), np.flatnonzero(hit & close)
    of, own = w.text[lo], w.first[w.text[lo]]
    offsets = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=n_texts))))
    spans = pa.StructArray.from_arrays([pa.array(lo - own, pa.int64()), pa.array(hi + 1 - own, pa.int64())], ["start", "end"])
    columns = {
        "doc_id": part["doc_id"],
        "n_words": pa.array(w.count, pa.int64()),
        "n_hit": pa.array(np.bincount(w.text[hit], minlength=n_texts), pa.int64()),
        "spans": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans),
        "items": pa.array([sorted(x for x in items.get(i, ()) if x is not None) for i in range(n_texts)], pa.list_(pa.string())),
    }
    if carry:
        left = part["text"].to_pylist()
        for i in np.unique(of).tolist():
            base, at, kept, data = int(w.texts[i]), 0, [], left[i].encode("utf-8", "surrogatepass")
            for k in range(offsets[i], offsets[i + 1]):
                kept.append(data[at : int(w.start[lo[k]]) - base])
                at = int(w.end[hi[k]]) - base
            left[i] = b"".join([*kept, data[at:]]).decode("utf-8", "surrogatepass")
        columns |= {"text": pa.array(left, pa.string()), "row": part["row"]}
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _schema(kind: T.DataType, row: T.DataType | None) -> T.StructType:
    out = T.StructType().add("doc_id", kind).add("n_words", "long").add("n_hit", "long")
    out = out.add("spans", T.ArrayType(T.StructType().add("start", "long").add("end", "long"))).add("items", T.ArrayType(T.StringType()))
    return out.add("text", "string").add("row", row) if row is not None else out


def _scan(rows: DataFrame, items: DataFrame, length: int, max_bytes: int) -> DataFrame:
    """``rows`` (doc_id, text and perhaps row) with their overlaps."""
    carry = "row" in rows.columns
    schema = _schema(rows.schema["doc_id"].dataType, rows.schema["row"].dataType if carry else None)
    size = items.agg(F.sum(F.octet_length("text") + F.coalesce(F.octet_length("item"), F.lit(0)) + 16)).first()[0] or 0
    if size > max_bytes:
        return _joined(rows, items, length, schema)
    held = items.collect()
    shared = rows.sparkSession.sparkContext.broadcast(ItemSet([r["item"] for r in held], [r["text"] for r in held], length))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (s for b in batches for s in _slices(b)):
            w = Words(part["text"])
            yield _told(part, w, *shared.value.hits(w), carry)

    return rows.mapInArrow(scan, schema)


def _joined(rows: DataFrame, items: DataFrame, length: int, schema: T.StructType) -> DataFrame:
    """The same overlaps by a join of the documents' windows with the items'."""

    def item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (s for b in batches for s in _slices(b)):
            w = Words(part["text"])
            h, rows = w.hashes(), defaultdict(list)
            for k in sorted(set(np.minimum(w.count, length).tolist()) - {0}):
                windows = w.windows(h, k)
                at = np.flatnonzero(np.minimum(w.count, length)[w.text[: len(windows)]] == k)
                at = at[w.whole(at, k)]
                rows["h"] += windows[at].view(np.int64).tolist()
                rows["k"] += [k] * len(at)
                rows["words"] += [w.spelled(a, k) for a in at.tolist()]
                rows["item"] += part["item"].take(pa.array(w.text[at])).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["h"], pa.int64()), pa.array(rows["k"], pa.int64()), pa.array(rows["words"], pa.binary()), pa.array(rows["item"], pa.string())], ["h", "k", "words", "item"]
            )

    windows = cut_lineage(items.mapInArrow(item_windows, "h long, k long, words binary, item string").distinct(), "item-windows")
    bit = windows.select("k", F.shiftrightunsigned("h", 64 - FILTER_BITS).alias("bit"))
    marks = bit.groupBy("k", F.expr("bit div 64").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("bits"))
    tables = {}
    for r in marks.collect():  # at most 2^20 words for each of the lengths
        tables.setdefault(r["k"], np.zeros(1 << (FILTER_BITS - 6), np.int64))[r["at"]] = r["bits"]
    shared = rows.sparkSession.sparkContext.broadcast(tables)
    keyed = cut_lineage(rows.withColumn("at_row", F.monotonically_increasing_id()), "rows")

    def doc_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (s for b in batches for s in _slices(b)):
            w = Words(part["text"])
            h = w.hashes()
            for k, table in shared.value.items():
                windows = w.windows(h, k)
                bit = (windows >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                at = np.flatnonzero(table[bit >> 6] >> (bit & 63) & 1)
                at = at[w.whole(at, k)] if len(at) else at
                yield pa.RecordBatch.from_arrays(
                    [
                        part["at_row"].take(pa.array(w.text[at])),
                        pa.array(at - w.first[w.text[at]], pa.int64()),
                        pa.array(windows[at].view(np.int64)),
                        pa.array(np.full(len(at), k, np.int64)),
                        pa.array([w.spelled(a, k) for a in at.tolist()], pa.binary()),
                    ],
                    ["at_row", "first", "h", "k", "words"],
                )

    asked = keyed.select("at_row", "text").mapInArrow(doc_windows, "at_row long, first long, h long, k long, words binary")
    met = cut_lineage(asked.join(windows.select("h", "k", "words").distinct(), ["h", "k", "words"]), "hits")
    by_row = met.groupBy("at_row").agg(F.collect_list(F.struct("first", "k")).alias("hits"))
    named = met.select("at_row", "h", "k", "words").distinct().join(windows, ["h", "k", "words"])
    of = named.groupBy("at_row").agg(F.collect_set("item").alias("named"))
    told = keyed.join(by_row, "at_row", "left").join(of, "at_row", "left").drop("at_row")
    carry = "row" in rows.columns

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (s for b in batches for s in _slices(b)):
            w = Words(part["text"])
            starts, lengths, items = [], [], {}
            for i, (hits, named) in enumerate(zip(part["hits"].to_pylist(), part["named"].to_pylist(), strict=True)):
                starts += [int(w.first[i]) + x["first"] for x in hits or ()]
                lengths += [x["k"] for x in hits or ()]
                items[i] = set(named or ())
            yield _told(part, w, np.array(starts, np.int64), np.array(lengths, np.int64), items, carry)

    return told.mapInArrow(finish, schema)


def _items(items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    return items.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text")).where("text is not null")


def find_overlaps(docs: DataFrame, items: DataFrame, length: int = 10, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", max_item_bytes: int = MAX_ITEM_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, spans, items) for every row of ``docs``: its words,
    those inside an item's window, their word spans (end exclusive) and the
    ids of the items, as sorted strings."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return _scan(rows, _items(items, item_id, item_text), length, max_item_bytes)


def decontaminate(docs: DataFrame, items: DataFrame, remove: str = "spans", length: int = 10, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", max_item_bytes: int = MAX_ITEM_BYTES) -> DataFrame:
    """``docs`` without the text of its hit spans, or without the documents that
    have any (``remove="documents"``). A null text stays null."""
    if remove not in ("spans", "documents"):
        raise ValueError("remove must be 'spans' or 'documents'")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = _scan(rows, _items(items, item_id, item_text), length, max_item_bytes)
    if remove == "documents":
        return found.where("n_hit = 0").select("row.*")
    text = F.when(F.col("n_hit") > 0, F.col("text")).otherwise(F.col(f"row.`{text_col}`"))
    return found.select([text.alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])
