"""Cost-balanced packing of token sequences.

Attention over a document of n tokens costs about ``n + n * n / window``. All
documents are tokenized once; a document longer than the window gives full
pieces that fill sequences by themselves, and its rest joins the documents of
its shard. A shard holds about ``SHARD_TOKENS`` tokens of rests, dealt by a
hash of document id, text and task, and is packed on its own: it opens
ceil(tokens / window) sequences, takes the rests in descending cost, and gives
each to the sequence of lowest cost that still has room for it. A rest that fits nowhere whole
is cut over the sequences with room, lowest cost first. So the
sequences of a shard leave room for less than one window in all. The shards' number
follows the input's bytes and rows; a task holds one shard's token ids (2 bytes each).
Rows equal in id and text share a shard only as far as one input partition holds them.

Encoding part by part: the tokenizer cuts a text into lower-case letter runs,
digits and runs of other characters before it merges within them, each part
ending with an id that marks an end. Texts of printable ASCII and Latin-1
letters are cut the same way with Arrow functions: a slice's distinct lower-case
words between spaces, their distinct parts; new parts are encoded (a bounded
cache, one per worker process), and a text's ids are joined from its words'.
All other texts go to the tokenizer as they are.

Defined results: null and empty texts consist of the closing id alone; repeated
rows are packed as separate documents; ids may be null; an empty table gives an
empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit, Sequence

from reverbkit.llm.common import give_back, texts

WINDOW = 4096
SHARD_TOKENS = 1 << 20
CACHED_PARTS = 500_000
SLICE_BYTES = 4 << 20
#: Parts and texts that the tokenizer gets at once; its results take far more memory than their ids.
PARTS_AT_ONCE, TEXTS_AT_ONCE = 8_192, 64
#: What a plain text does not hold, and a plain lower-case word's parts.
NOT_PLAIN = "[^\\n -~À-ÖØ-öø-ÿ]"
PART = "('(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+)"
SCHEMA = "doc_id {0}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@cache
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


class PartIds:
    """The ids (little-endian unsigned 32-bit numbers) of parts. Known parts lie in an
    Arrow array, their ids in another."""

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        # parts are lower-case, composed and cut already: the same model takes them between spaces
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = Sequence([CharDelimiterSplit(" "), ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocab.values()) + 1, bool)
        self.is_end[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.parts, self.ids = pa.array([""], pa.string()), pa.array([b""], pa.large_binary())

    def spelled(self, parts: pa.Array) -> pa.Array:
        if len(self.parts) > CACHED_PARTS:
            self.forget()
        parts = parts.cast(pa.string())
        number = pc.fill_null(pc.index_in(parts, value_set=self.parts), -1).to_numpy().copy()
        new, made = parts.filter(pa.array(number < 0)), [self.ids]
        number[number < 0] = np.arange(len(self.parts), len(self.parts) + len(new))
        for at in range(0, len(new), PARTS_AT_ONCE):
            # many new parts as one text, its ids cut after each end
            some = new.slice(at, PARTS_AT_ONCE)
            ids = np.array(self.merges.encode_batch_fast([" ".join(some.to_pylist())], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.is_end[ids]) + 1
            if len(cuts) != len(some):
                raise ValueError(f"{len(some)} parts have {len(cuts)} ends")
            made.append(_strings(np.concatenate(([0], 4 * cuts)), pa.py_buffer(ids)))
        self.parts, self.ids = pa.concat_arrays([self.parts, new]), pa.concat_arrays(made)
        return self.ids.take(pa.array(number))

    def encode(self, texts: pa.Array, closing: int) -> list[bytes]:
        """The ids of each text, the closing id included."""
        end = closing.to_bytes(4, "little")
        plain = pc.and_(pc.invert(pc.match_substring_regex(texts, NOT_PLAIN)), pc.invert(pc.match_substring(texts, "<|")))
        plain = plain.to_numpy(zero_copy_only=False)
        out: list[bytes] = [b""] * len(texts)
        others = np.nonzero(~plain)[0].tolist()
        for at in range(0, len(others), TEXTS_AT_ONCE):
            some = others[at : at + TEXTS_AT_ONCE]
            for i, e in zip(some, self.tokenizer.encode_batch([texts[i].as_py() for i in some], add_special_tokens=False), strict=True):
                out[i] = np.array(e.ids, "<u4").tobytes() + end
        if plain.any():
            low = pc.replace_substring(pc.utf8_lower(texts.filter(pa.array(plain))), "\n", " ")
            words, spans = _dictionary(pc.split_pattern(low, " "))
            parts, inside = _dictionary(pc.split_pattern(pc.ascii_rtrim(pc.replace_substring_regex(words.dictionary, PART, "\\1 "), " "), " "))
            known = _joined(self.spelled(parts.dictionary).take(parts.indices), inside)
            whole = _joined(known.take(words.indices), spans)
            for i, ids in zip(np.nonzero(plain)[0].tolist(), whole.to_pylist(), strict=True):
                out[i] = ids + end
        return out


def _dictionary(lists: pa.ListArray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All strings of some lists, dictionary-encoded, and where each list begins and the last ends."""
    return lists.flatten().dictionary_encode(), lists.offsets.to_numpy() - lists.offsets[0].as_py()


def _strings(cuts: np.ndarray, data: pa.Buffer) -> pa.Array:
    """The byte strings between some places of a buffer."""
    return pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), data])


def _joined(strings: pa.Array, spans: np.ndarray) -> pa.Array:
    """Neighbouring byte strings as one, where ``spans`` says which."""
    _, offsets, data = strings.buffers()
    return _strings(np.frombuffer(offsets, np.int64)[strings.offset : strings.offset + len(strings) + 1][spans], data)


def _slices(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of about ``SLICE_BYTES`` of text at a time."""
    ends, at = np.cumsum(pc.binary_length(b["text"]).to_numpy()), 0
    while at < b.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES)))
        yield b.slice(at, to - at)
        at = to
    give_back()


@cache
def part_ids(path: str) -> PartIds:
    """One cache for all tasks of a worker process."""
    return PartIds(path)


def pack(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Packs documents of 1 to ``window`` - 1 tokens: (document, start, length,
    sequence, offset) of each piece."""
    count = -(-sum(lengths) // window)
    room, cost, out, loose = np.full(count, window), np.zeros(count), [], []

    def put(doc: int, start: int, n: int, s: int) -> None:
        out.append((doc, start, n, s, window - int(room[s])))
        room[s] -= n
        cost[s] += n + n * n / window

    for doc in sorted(range(len(lengths)), key=lambda d: (-lengths[d], d)):
        fits = room >= lengths[doc]
        if fits.any():
            put(doc, 0, lengths[doc], int(np.where(fits, cost, np.inf).argmin()))
        else:
            loose.append(doc)
    for doc in loose:
        start = 0
        while start < lengths[doc]:
            s = int(np.where(room > 0, cost, np.inf).argmin())
            n = min(lengths[doc] - start, int(room[s]))
            put(doc, start, n, s)
            start += n
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, closing: int = 2, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset. Sequence ids are shard * 2^32 + number in the shard."""
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    size, count = rows.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    # a token has two bytes or more of text, nearly always, and every document one more; the number only sets how large shards get
    shards = max(1, round(((size or 0) / 2 + count) / SHARD_TOKENS))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = part_ids(tokenizer_path)
        # a retried task has the same number; equal rows of many tasks do not share a shard
        salt = TaskContext.get().partitionId()
        # no name holds a batch while the next one is read
        while (b := next(batches, None)) is not None:
            parts = _slices(b)
            del b
            for part in parts:
                full, rest, total, shard = [], [], [], []
                for i, ids in zip(part["doc_id"].to_pylist(), known.encode(part["text"], closing), strict=True):
                    n = len(ids) // 4
                    cut = n // window * window * 4
                    full.append([zlib.crc32(ids[k : k + 4 * window]) for k in range(0, cut, 4 * window)])
                    rest.append(np.frombuffer(ids, "<u4", offset=cut).astype("<u2" if known.tokenizer.get_vocab_size() <= 1 << 16 else "<u4").tobytes())
                    total.append(n)
                    shard.append(zlib.crc32(f"{salt} {i} {zlib.crc32(ids)}".encode()) % shards)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(shard, pa.int64()), pa.array(total, pa.int64()), pa.array(full, pa.list_(pa.int64())), pa.array(rest, pa.binary())],
                    ["doc_id", "shard", "total", "full", "rest"],
                )
            parts = part = None

    def packed(table: pa.Table) -> pa.Table:
        wide = tokenizer(tokenizer_path).get_vocab_size() > 1 << 16
        total, full, base = table["total"].to_pylist(), table["full"].to_pylist(), table["shard"][0].as_py() << 32
        rest = [np.frombuffer(x, "<u4" if wide else "<u2").astype("<u4") for x in table["rest"].to_pylist()]
        order = [d for d in range(len(rest)) if len(rest[d])]
        out = []  # document, start, length, crc, sequence, offset
        pieces = pack([len(rest[d]) for d in order], window)
        for k, start, n, s, at in pieces:
            d = order[k]
            out.append((d, total[d] - len(rest[d]) + start, n, zlib.crc32(rest[d][start : start + n].tobytes()), base + s, at))
        s = base + 1 + max((p[3] for p in pieces), default=-1)
        for d, crcs in enumerate(full):
            for k, c in enumerate(crcs):
                out.append((d, k * window, window, c, s, 0))
                s += 1
        columns = list(zip(*out, strict=True))
        ids = table["doc_id"].combine_chunks().take(pa.array(columns[0], pa.int64()))
        numbers = [pa.array(c, pa.int64()) for c in (columns[1], columns[2], columns[3], [total[d] for d in columns[0]], columns[4], columns[5])]
        return pa.Table.from_arrays([ids, *numbers], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    schema = f"doc_id {kind}, shard long, total long, full array<long>, rest binary"
    return rows.mapInArrow(encoded, schema).groupBy("shard").applyInArrow(packed, SCHEMA.format(kind))
