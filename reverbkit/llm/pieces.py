"""Encoding and decoding with a SentencePiece vocabulary: shared-prefix Viterbi.

A text is cut before each run of spaces (marked by U+2581), which no piece
crosses. The distinct marked words of a batch are sorted, so that they form a
trie in depth-first order; each word keeps the forward table (for every prefix:
the best path's score and last piece) of the prefix it shares with the word
before, and only the rest is computed.

The vocabulary is of the merge kind: the right pieces are those that merging
the best-scored adjacent pair again and again leaves. That is a Viterbi path
too, if two pieces may follow each other only when merging their joined
characters leaves just these two: then one path through any word is allowed,
the merges' own. Which pairs may is computed by merging, once per pair.
Characters outside the vocabulary become their UTF-8 bytes' pieces.

Decoding joins the pieces, turns runs of byte pieces into text (invalid UTF-8
into U+FFFD) and drops the leading mark.

Defined results: null and empty texts have no ids and decode to the empty text;
repeated rows each get a row; ids may be null; an empty table gives an empty
result. Other columns of the input are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reverbkit.llm.common import texts

MARK = "▁"
WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
CACHED_WORDS = 1_000_000
CACHED_PAIRS = 2_000_000
UNKNOWN = -1e12  # score of a character outside the vocabulary


class Vocabulary:
    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.byte_id, self.id_of, self.score = {}, {}, {}
        for i, p in enumerate(self.pieces):
            if model.is_byte(i):
                self.byte_id[int(p[1:-1], 16)] = i
            elif not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i)):
                self.id_of[p], self.score[p] = i, model.get_score(i)
        # by a piece's last two characters, the length of the longest such piece
        self.longest: dict[str, int] = {}
        for p in self.id_of:
            self.longest[p[-2:]] = max(len(p), self.longest.get(p[-2:], 1))
        self.pairs: dict[tuple[str, str], bool] = {}
        self.whole = {p for p in self.id_of if len(p) == 1 or self.merged(p) == [p]}
        self.spelling = [bytes([int(p[1:-1], 16)]) if model.is_byte(i) else b"" if model.is_control(i) else p.replace(MARK, " ").encode() for i, p in enumerate(self.pieces)]

    def merged(self, chars: str) -> list[str]:
        """What merging the best-scored adjacent pair, the leftmost of equals,
        leaves of a short string."""
        parts = list(chars)
        while True:
            best = max(((self.score[a + b], -k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.score), default=None)
            if best is None:
                return parts
            k = -best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def follows(self, a: str, b: str) -> bool:
        """Whether b may stand right after a."""
        ok = self.pairs.get((a, b))
        if ok is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            ok = self.pairs[a, b] = self.merged(a + b) == [a, b]
        return ok

    def ids(self, piece: str) -> list[int]:
        i = self.id_of.get(piece)
        return [i] if i is not None else [self.byte_id[x] for x in piece.encode("utf-8", "surrogatepass")]

    def decode(self, ids: np.ndarray | list[int]) -> str:
        spelled = self.spelling
        return b"".join([spelled[i] for i in ids]).decode("utf-8", "replace")[1:]


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def segment(vocab: Vocabulary, words: list[str]) -> Iterator[tuple[str, list[str]]]:
    """The best path of each of the sorted words. ``table[j]`` is (score, last
    piece) of the best path through the first j characters; a word starts with
    the entries of its common prefix with the word before."""
    whole, score, longest, follows, known = vocab.whole, vocab.score, vocab.longest, vocab.follows, vocab.pairs.get
    table = [(0.0, "")]
    before = ""
    for word in words:
        shared = 0
        for a, b in zip(before, word, strict=False):
            if a != b:
                break
            shared += 1
        del table[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            # the pairs allow one path through each prefix, so the first piece that may stand here is its best
            for start in range(max(0, end - longest.get(word[end - 2 : end], 1)) if end > 1 else 0, end):
                piece = word[start:end]
                if piece in whole or end - start == 1:
                    total, last = table[start]
                    ok = True if not start else known((last, piece))
                    if ok or (ok is None and follows(last, piece)):
                        table.append((total + score.get(piece, UNKNOWN), piece))
                        break
        path, end = [], len(word)
        while end:
            piece = table[end][1]
            path.append(piece)
            end -= len(piece)
        yield word, path[::-1]
        before = word


class WordIds(dict):
    """The ids (bytes of little-endian unsigned 32-bit numbers) of marked words."""

    def __init__(self, path: str):
        super().__init__()
        self.vocab = vocabulary(path)

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self) > CACHED_WORDS:
            self.clear()
        split = [WORD.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        for word, path in segment(self.vocab, sorted(w for w in set().union(*split) if w not in self)):
            self[word] = np.array([i for p in path for i in self.vocab.ids(p)], "<u4").tobytes()
        return [b"".join(map(self.__getitem__, ws)) for ws in split]


@cache
def word_ids(path: str) -> WordIds:
    """One cache for all tasks of a worker process."""
    return WordIds(path)


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) for every row of ``docs``."""
    rows = texts(docs, id_col, text_col)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(model_path)
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in known.encode(part["text"].to_pylist())]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([part["doc_id"], lists], ["doc_id", "ids"])

    return rows.mapInArrow(encoded, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_ids, ids_crc32, decoded_ok) for every row of ``docs``, encoded
    and decoded in one pass, so that texts and ids don't move."""
    rows = texts(docs, id_col, text_col)

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(model_path)
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                whole = part["text"].to_pylist()
                ids = known.encode(whole)
                same = [known.vocab.decode(np.frombuffer(x, "<u4").tolist()) == t for x, t in zip(ids, whole, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(same, pa.bool_())],
                    ["doc_id", "n_ids", "ids_crc32", "decoded_ok"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(checked, f"doc_id {kind}, n_ids long, ids_crc32 long, decoded_ok boolean")


def decode(encoded: DataFrame, model_path: str, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` and ``text`` for every row (ids) of ``encoded``;
    null ids decode to null."""
    kept = [encoded.schema[c] for c in carry]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model_path)
        for b in batches:
            out = [vocab.decode(x.values.to_numpy().tolist()) if x.is_valid else None for x in b["ids"]]
            yield pa.RecordBatch.from_arrays([*(b[c] for c in carry), pa.array(out, pa.string())], [*carry, "text"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return encoded.select(*carry, F.col("ids")).mapInArrow(decoded, f"{schema}, text string")
