"""Spelling variant grouping with a variable-length gram index.

Words are *near* if one inserted, deleted or replaced code point turns one into
the other. The join of the vocabulary with itself goes through variable grams:

1. Dictionary. Grams are counted over all words, level by level; only grams with
   more than ``T`` places are extended by one character (those places make the
   next level). What the dictionary keeps is thus pruned by frequency, and ``T``
   rises until it has at most ``MAX_GRAMS`` entries, the bound of its broadcast.
2. Decomposition. From each place of a word (closed by an end mark) runs the
   shortest gram that is not too frequent, of at most half the word. Which gram
   it is depends on its own characters alone, so a gram that an edit leaves
   untouched is a gram of the edited word as well, at the same place or shifted by
   the difference of the lengths.
3. Affected grams. An edit affects the grams it lies in. A set of grams survives
   any edit if no place lies in all of them; as intervals that pairwise meet share a
   place, that takes two disjoint grams. Each word merges just the lists of
   its cheapest disjoint pair, with the lists of words as long as itself or one longer.
4. A word whose cheapest pair still holds a gram with more than ``HOT * T`` places
   is met through its residues (the word less one code point), which at most an
   alphabet's worth of words share. Words longer than ``LONG`` take their two halves
   as grams, as an index of all their places would grow with the square of their length.
5. Pairs that meet are verified by their edit distance.

Lists are keyed by word length, place and gram, and only the pairs' lists are joined:
nothing is collected, and no list longer than ``HOT * T`` is read (halves of long
words excepted). The dictionary only decides which lists are merged, never the result.

Defined results: null and empty texts have no words; a null id is spelled as an empty
string; repeated rows count each for themselves. An empty table gives an empty
result. Other columns of the input are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reverbkit.llm.common import cut_lineage, slices, texts

RUN = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")  # a-z and U+00C0 to U+00FF in UTF-8
GAP = re.compile(rb"[\x00-\x60\x7b-\x7f]")
PIECE = 1 << 22  # bytes of a text looked at at a time
HELD_WORDS = 100_000  # words counted before they are handed on

SHORTEST, LONGEST = 2, 12  # gram lengths
T = 64  # places of a gram that is not extended
KEPT = 8  # grams with more than T / KEPT places are kept in the dictionary
HOT = 16
MAX_GRAMS = 4_000_000
LONG = 64
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
INDEX, PROBE, HOT_WORD = 0, 1, 2


def _runs(data: bytes) -> Counter:
    found, at = Counter(), 0
    while at < len(data):
        gap = GAP.search(data, at + PIECE) if len(data) - at > PIECE else None
        to = gap.start() if gap else len(data)
        found.update(RUN.findall(data, at, to))
        at = to
    return found


def _typed(run: bytes, seed: int, every: int) -> bytes:
    """The run, or the run less one code point where the hash says so."""
    h = zlib.crc32(run, seed)
    if h % every:
        return run
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def corpus_words(docs: DataFrame, least_length: int = 7, least_count: int = 2, drop_every: int = 31, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of all texts, one in ``drop_every`` (by the hash of id and
    run) less one code point, of ``least_length`` code points and ``least_count`` occurrences."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def handed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()).cast(pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for part in (s for b in batches for s in slices(b)):
            for i, t in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
                seed = zlib.crc32(f"{'' if i is None else i}:".encode())
                for run, n in _runs(t.encode("utf-8", "surrogatepass").lower()).items():
                    if len(run) >= least_length:
                        word = _typed(run, seed, drop_every)
                        held[word] = held.get(word, 0) + n
            if len(held) >= HELD_WORDS:
                yield handed()
                held.clear()
        yield handed()

    rows = texts(docs, id_col, text_col)
    found = rows.mapInArrow(counted, "word string, n long").where(F.length("word") >= least_length)
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class _Places:
    """All places of some words, each word closed by an end mark."""

    def __init__(self, words: list[str]) -> None:
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.codes = np.frombuffer("".join([w + "\0" for w in words]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        stops = np.cumsum(self.length + 1)
        self.first = stops - self.length - 1
        self.word = np.repeat(np.arange(len(words)), self.length + 1)
        self.at = np.arange(len(self.codes)) - self.first[self.word]
        self.left = stops[self.word] - np.arange(len(self.codes))

    def grams(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each gram length the places asked to go on, and their grams' hashes.
        Send back which of them go on to the next length."""
        on = np.flatnonzero(self.left >= SHORTEST)
        h = np.zeros(len(on), np.uint64)
        for k in range(SHORTEST - 1):
            h = (h + self.codes[on + k] + np.uint64(1)) * _MIX
        for length in range(SHORTEST, LONGEST + 1):
            h = (h + self.codes[on + length - 1] + np.uint64(1)) * _MIX
            h ^= h >> np.uint64(32)
            further = yield length, on, h
            further = further & (self.left[on] > length)
            on, h = on[further], h[further]


class Dictionary:
    """Frequent grams by length: sorted hashes and places. ``t`` is the pruning bound."""

    def __init__(self, t: int) -> None:
        self.t, self.levels = t, {}

    def places(self, length: int, h: np.ndarray) -> np.ndarray:
        """How many places the grams have, or 0 for those not kept."""
        keys, n = self.levels.get(length, (None, None))
        if keys is None or not len(keys) or not len(h):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return np.where(keys[at] == h, n[at], 0)

    def cut(self, p: _Places, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each place's gram, at most ``limit`` long: length (0: none), hash, places."""
        size, keys, cost = np.zeros(len(p.codes), np.int64), np.zeros(len(p.codes), np.uint64), np.zeros(len(p.codes), np.int64)
        steps = p.grams()
        length, on, h = next(steps)
        while True:
            n = self.places(length, h)
            size[on], keys[on], cost[on] = length, h, np.maximum(n, self.t // KEPT)
            try:
                length, on, h = steps.send((n > self.t) & (limit[on] > length))
            except StopIteration:
                return size, keys, cost


def learn(words: DataFrame, t: int = T, max_grams: int = MAX_GRAMS) -> Dictionary:
    """The pruned gram dictionary of (word, ..) rows, level by level."""
    known = Dictionary(t)  # what is broadcast has at most max_grams entries of 16 bytes
    short = words.where(F.length("word") <= LONG).select("word")
    for level in range(SHORTEST, LONGEST):

        shared = words.sparkSession.sparkContext.broadcast(known)

        def counted(batches: Iterator[pa.RecordBatch], level: int = level, shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for part in (s for b in batches for s in slices(b, 8192)):
                steps = _Places(part["word"].to_pylist()).grams()
                length, _, h = next(steps)
                while length < level:
                    length, _, h = steps.send(known.places(length, h) > known.t)
                keys, n = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n, pa.int64())], ["h", "n"])

        least = known.t // KEPT
        grams = short.mapInArrow(counted, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") > least)
        grams = cut_lineage(grams, "grams")
        room = max_grams - sum(len(k) for k, _ in known.levels.values())
        while grams.where(F.col("n") > known.t // KEPT).count() > room // 2:
            known.t *= 2
        rows = grams.where(F.col("n") > known.t // KEPT).toArrow()
        h = rows["h"].to_numpy().view(np.uint64)
        order = np.argsort(h)
        known.levels[level] = h[order], rows["n"].to_numpy()[order]
        if not (known.levels[level][1] > known.t).any():
            break
    return known


def _key(length: np.ndarray, at: np.ndarray, size: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The list of a gram: of words of ``length``, at place ``at``."""
    for x in (length, at, size):
        h = (h ^ x.astype(np.uint64)) * _STEP
        h ^= h >> np.uint64(31)
    return h


def _cheapest(p: _Places, size: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word the places of its cheapest disjoint pair of grams, and whether
    there is one (words of three code points or more have some)."""
    pairs, any_ = np.zeros((len(p.length), 2), np.int64), np.zeros(len(p.length), bool)
    for m in np.unique(p.length).tolist():
        of = np.flatnonzero(p.length == m)
        grid = p.first[of][:, None] + np.arange(m + 1)[None, :]
        sizes, costs = size[grid], np.where(size[grid] > 0, cost[grid], 1 << 40)
        row = np.arange(len(of))
        ended = np.full((len(of), m + 2), 1 << 41)  # the cheapest gram that ends by a place
        where = np.zeros((len(of), m + 2), np.int64)
        best, left, right = np.full(len(of), 1 << 42), np.zeros(len(of), np.int64), np.zeros(len(of), np.int64)
        for at in range(m + 1):
            if at:
                earlier = ended[:, at - 1] < ended[:, at]
                ended[:, at] = np.where(earlier, ended[:, at - 1], ended[:, at])
                where[:, at] = np.where(earlier, where[:, at - 1], where[:, at])
            total = costs[:, at] + ended[:, at]
            better = total < best
            best, left, right = np.where(better, total, best), np.where(better, where[:, at], left), np.where(better, at, right)
            end = at + sizes[:, at]
            lower = costs[:, at] < ended[row, end]
            ended[row[lower], end[lower]] = costs[lower, at]
            where[row[lower], end[lower]] = at
        pairs[of, 0], pairs[of, 1] = p.first[of] + left, p.first[of] + right
        any_[of] = best < 1 << 40
    return pairs, any_


def _half(word: str, a: int, b: int | None = None) -> int:
    return xxhash.xxh64_intdigest((word + "\0")[a:b].encode("utf-8", "surrogatepass"))


def _long_entries(word: str) -> Iterator[tuple[int, int, int, int, int]]:
    """(role, list's word length, place, gram length, gram) of a word over ``LONG``."""
    m = len(word)
    for p in {m, max(m - 1, LONG + 1)}:  # the lengths of words that look for this one
        half, rest = (p + 1) // 2, p + 1 - (p + 1) // 2
        yield INDEX, m, 0, half, _half(word, 0, half)
        yield INDEX, m, m + 1 - rest, rest, _half(word, m + 1 - rest)
    half, rest = (m + 1) // 2, m + 1 - (m + 1) // 2
    for at, size, h in ((0, half, _half(word, 0, half)), (half, rest, _half(word, half))):
        yield PROBE, m, at, size, h
        yield PROBE, m + 1, at, size, h
        yield PROBE, m + 1, at + 1, size, h


def _entries(shared: Broadcast) -> Callable:
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for part in (s for b in batches for s in slices(b, 4096)):
            words = part["word"].to_pylist()
            p = _Places([w if len(w) <= LONG + 1 else "" for w in words])
            m = p.length[p.word]
            size, h, cost = known.cut(p, (m + 1) // 2)
            size2, h2, cost2 = known.cut(p, m // 2)
            asked = (size > 0) & (m > 0) & (m <= LONG) & (cost <= HOT * known.t)
            # for words one shorter, whose grams end sooner where half a word is less
            also = (size2 > 0) & ((size2 != size) | (m > LONG)) & (m > 0) & (cost2 <= HOT * known.t)
            pairs, any_ = _cheapest(p, size, cost)
            own = np.flatnonzero((p.length > 0) & (p.length <= LONG))
            hot = ~any_[own] | (cost[pairs[own]] > HOT * known.t).any(axis=1)
            pairs, hot_words = pairs[own[~hot]].ravel(), own[hot]
            key = [_key(m[asked], p.at[asked], size[asked], h[asked]), _key(m[also], p.at[also], size2[also], h2[also])]
            for longer, shift in ((0, 0), (1, 0), (1, 1)):
                key.append(_key(m[pairs] + longer, p.at[pairs] + shift, size[pairs], h[pairs]))
            rows = [p.word[asked], p.word[also], *[p.word[pairs]] * 3, hot_words]
            roles = [INDEX, INDEX, PROBE, PROBE, PROBE, HOT_WORD]
            long_ = [(k, *x) for k, w in enumerate(words) if len(w) > LONG for x in _long_entries(w)]
            if long_:
                at, role, *lists = (np.array(c, np.uint64) for c in zip(*long_, strict=True))
                key.append(_key(*lists))
            key.insert(5, np.zeros(len(hot_words), np.uint64))
            row = np.concatenate([*rows, *([at.astype(np.int64)] if long_ else [])])
            role_ = np.concatenate([np.full(len(r), x) for r, x in zip(rows, roles, strict=True)] + ([role.astype(np.int64)] if long_ else []))
            taken = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(key).view(np.int64)), pa.array(role_.astype(np.int8)), part["word"].take(taken), part["n"].take(taken)],
                ["key", "role", "word", "n"],
            )

    return entries


def _residues(also_whole: bool) -> Callable:
    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The distinct residues of each word, and the word itself if asked."""
        for part in (s for b in batches for s in slices(b, 2048)):
            at, keys = [], []
            for k, w in enumerate(part["word"].to_pylist()):
                own = {w[:i] + w[i + 1 :] for i in range(len(w))} | ({w} if also_whole else set())
                keys += [xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass")) for x in own]
                at += [k] * len(own)
            taken = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.uint64).view(np.int64)), part["word"].take(taken), part["n"].take(taken)], ["key", "word", "n"])

    return residues


def near_pairs(words: DataFrame, t: int = T) -> DataFrame:
    """(u, nu, v, nv): each pair of near words of (word, n) once, u the shorter one
    or, of equally long ones, the smaller."""
    kind = "key long, word string, n long"
    grams = words.sparkSession.sparkContext.broadcast(learn(words, t))
    entries = cut_lineage(words.mapInArrow(_entries(grams), "key long, role byte, word string, n long"), "gram-lists")

    def met(index: DataFrame, probes: DataFrame) -> DataFrame:
        index = index.select("key", F.col("word").alias("v"), F.col("n").alias("nv"))
        probes = probes.select("key", F.col("word").alias("u"), F.col("n").alias("nu"))
        return index.join(probes, "key").where("(length(u) < length(v) or u < v) and levenshtein(u, v, 1) = 1").select("u", "nu", "v", "nv")

    hot = entries.where(F.col("role") == HOT_WORD).select("word", "n")
    by_grams = met(entries.where(F.col("role") == INDEX), entries.where(F.col("role") == PROBE))
    if not hot.isEmpty():
        short = words.where(F.length("word") <= LONG + 1).select("word", "n")
        by_grams = by_grams.unionByName(met(short.mapInArrow(_residues(False), kind), hot.mapInArrow(_residues(True), kind)))
    return by_grams.distinct()


def variants(words: DataFrame, ratio: int = 10, t: int = T) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of (word, n), whose words
    are distinct and not empty: the near word of largest n (ties: the smallest) if it has ``ratio``
    times the occurrences, and what following forms ends at."""
    if ratio < 2:
        raise ValueError("forms of a ratio below 2 could lead in circles")
    words = cut_lineage(words.select("word", F.col("n").cast("long").alias("n")), "words")
    pairs = cut_lineage(near_pairs(words, t), "near-pairs")
    near = pairs.select(F.col("u").alias("word"), F.col("nv").alias("m"), F.col("v").alias("near")).unionByName(pairs.select(F.col("v").alias("word"), F.col("nu").alias("m"), F.col("u").alias("near")))
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
    known = words.join(best, "word", "left")
    of_weight = -F.col("best.m") >= F.col("n") * ratio
    known = cut_lineage(
        known.select(
            "word",
            F.when(of_weight, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(of_weight, -F.col("best.m")).alias("form_n"),
        ),
        "forms",
    )
    return known.join(_roots(known), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(known: DataFrame) -> DataFrame:
    """(word, root) of words with a form, by pointer jumping: each round doubles the
    way, and a way has few steps, as each multiplies n by ``ratio``."""
    way = known.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        onward = way.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = cut_lineage(way.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        way = jumped.select("word", "root")
        if jumped.where("moved").isEmpty():
            return way


def spelling_variants(docs: DataFrame, least_length: int = 7, least_count: int = 2, drop_every: int = 31, ratio: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The variants among the words of all texts of ``docs``."""
    return variants(corpus_words(docs, least_length, least_count, drop_every, id_col, text_col), ratio)
