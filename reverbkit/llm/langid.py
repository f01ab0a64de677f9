"""Language ID by language-bitmask n-gram filters.

One Bloom filter per language, laid out bit-sliced: a table of 2^``POSITIONS``
bitmasks whose bit l belongs to language l's filter. ANDing the masks at an
n-gram's ``HASHES`` positions returns all languages that (seem to) contain it
in one go. A text's trigrams are looked up, the hits are counted per language
and corrected for the filters' false positives, (hits - n * f) / (1 - f) with
f = (share of set bits) ** ``HASHES``; the largest count wins, on a tie the
language with fewer n-grams, then the smaller name.

A trigram (of lower-case letters; anything else is one space) belongs to a
language if it occurs in at least ``MIN_SHARE`` of its texts; a relative bound,
so that the filters stay as full as they are however many texts are read, and
stray words don't count. All texts of the learning fold are read.

Defined results: null texts and texts without a letter are ``und`` with score
0, and so is everything if nothing was learned; texts without a known trigram
get the language with the fewest n-grams and score 0; repeated rows each get a
row; null languages teach nothing; an empty table gives an empty result. Other
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reverbkit.llm.common import cut_lineage

POSITIONS = 18
HASHES = 3
MIN_SHARE = 0.02


@cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def trigrams(text: str) -> np.ndarray:
    """The text's trigrams, repeats included, as numbers; none if no letter."""
    c = np.frombuffer(f" {text} ".lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    letter = _letters()[c]
    if not letter.any():
        return np.zeros(0, np.int64)
    c = np.where(letter, c, 32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[0] = True
    c = c[keep]
    # a run of other characters is the one space after a letter, or the first
    return c[:-2] << 42 | c[1:-1] << 21 | c[2:]


def _positions(grams: np.ndarray) -> np.ndarray:
    h = grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return np.stack([(h >> np.uint64(POSITIONS * i)).astype(np.int64) & ((1 << POSITIONS) - 1) for i in range(HASHES)])


@dataclass
class Filters:
    languages: list[str]  # those with fewer n-grams first
    masks: np.ndarray  # (positions, words of 64 languages)
    false_rate: np.ndarray

    def counts(self, grams: np.ndarray) -> np.ndarray:
        """Estimated numbers of the grams that each language contains."""
        p = _positions(grams)
        m = self.masks[p[0]]
        for row in p[1:]:
            m = m & self.masks[row]
        hits = np.array([(m[:, k // 64] >> np.uint64(k % 64) & np.uint64(1)).sum() for k in range(len(self.languages))], np.float64)
        return ((hits - len(grams) * self.false_rate) / (1 - self.false_rate)).clip(0)

    def predict(self, text: str) -> tuple[str, float]:
        grams = trigrams(text)
        if not len(grams) or not self.languages:
            return "und", 0.0
        counts = self.counts(grams)
        best = int(counts.argmax())
        return self.languages[best], float(min(1.0, counts[best] / max(len(grams), 1)))


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Filters:
    """Filters of all languages of ``docs``."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by_lang: dict[str, list[np.ndarray]] = {}
            for t, lang in zip(b["text"], b["lang"].to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(np.unique(trigrams(t.as_py())))
            for lang, found in by_lang.items():
                grams, n = np.unique(np.concatenate(found), return_counts=True)
                grams, n = np.append(grams, -1), np.append(n, len(found))  # -1: the texts themselves
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n)), pa.array(grams), pa.array(n)], ["lang", "gram", "n"])

    counts = cut_lineage(rows.mapInArrow(counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "trigrams")
    n_texts = {r["lang"]: r["n"] for r in counts.where("gram = -1").collect()}
    common = counts.where("gram <> -1").join(F.broadcast(counts.where("gram = -1").select("lang", F.col("n").alias("texts"))), "lang")
    # at most 1 / MIN_SHARE times the trigrams of an average text for each language
    sets = {lang: [] for lang in n_texts}
    for r in common.where(F.col("n") >= MIN_SHARE * F.col("texts")).select("lang", "gram").collect():
        sets[r["lang"]].append(r["gram"])
    languages = sorted(sets, key=lambda k: (len(sets[k]), k))
    masks = np.zeros((1 << POSITIONS, -(-max(1, len(languages)) // 64)), np.uint64)
    fill = []
    for k, lang in enumerate(languages):
        at = np.unique(_positions(np.array(sets[lang], np.int64)))
        masks[at, k // 64] |= np.uint64(1 << k % 64)
        fill.append(len(at) / (1 << POSITIONS))
    return Filters(languages, masks, np.array(fill) ** HASHES)


def identify(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [filters.predict(t.as_py() or "") for t in b["text"]]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(predicted, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")
