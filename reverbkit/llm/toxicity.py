"""Toxicity by a weighted finite-state pattern grammar.

Five small transducers read the symbols of a clause's words side by side:
insult, threat (a threatening verb that a target follows), target, negation and
reported speech. Their composition emits one pattern per insult or threat:
``plain``, ``aimed`` (a target stands in the clause), ``negated``, ``reported``
(said by someone else or quoted) or ``threat``. A document's score adds up the
weights of its matched clauses, not of isolated words.

Learned from labelled rows, at most ``SAMPLE`` of each label (those whose id
hashes lowest), near copies among them counted once (one five-word minhash; the
text with the smallest id stands for them):

* insult words and stems (the first 4 to 8 letters): significantly (G test)
  more frequent in toxic than in clean texts; of those, a greedy cover keeps
  what explains toxic texts that nothing kept before explains, until no entry
  gains any (``SAMPLE`` bounds how many there can be);
* pattern weights: smoothed log odds of the label, given the strongest pattern.

Cover and weights count each sampled row as many times as its label has labelled
rows for each sampled one, so a label that ``SAMPLE`` cuts keeps its true share.

Defined results: null and empty texts match nothing and get the score of
documents without a match; repeated rows each get a row; without usable labels
the built-in words and prior weights decide; an empty table gives an empty
result. Other columns of the input are ignored.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reverbkit.llm.common import cut_lineage, slices, texts

SAMPLE = {1: 10_000, 0: 30_000}
MIN_G = 30.0
MIN_RATIO = 12.0
STEM = range(4, 9)

INSULTS = "idiot idiots moron morons imbecile cretin loser losers scum scumbag worthless pathetic disgusting stupid dumb trash vermin bastard jerk".split()
THREATS = "kill hurt destroy strangle murder stab shoot beat crush".split()
TARGETS = "you your yours u he she they them him her people everyone women men immigrants du dich dir euch ihr tu te toi vous ti usted ustedes".split()
NEGATIONS = "not no never isn't aren't don't won't wasn't nicht kein keine ne pas jamais nunca".split()
REPORTS = "said says say wrote claims claimed called quoted quote reported sagte schrieb dijo dit".split()
#: Prior probability that a document whose strongest pattern this is, is toxic.
PRIOR = {"aimed": 0.95, "plain": 0.9, "threat": 0.9, "reported": 0.55, "negated": 0.45, "none": 0.03}
PRIOR_ROWS = 4.0

WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE_END = re.compile(r"[.!?;:,\n]")


class Transducer:
    """State after a symbol = arcs[state, symbol], else arcs[state, None], else 0."""

    def __init__(self, arcs: dict):
        self.arcs = arcs

    def step(self, state: int, symbol: str) -> int:
        return self.arcs.get((state, symbol), self.arcs.get((state, None), 0))


def _within(symbol: str, words: int) -> Transducer:
    """State > 0 while ``symbol`` was among the last ``words`` words."""
    arcs = {(s, symbol): words for s in range(words + 1)}
    return Transducer(arcs | {(s, None): s - 1 for s in range(1, words + 1)})


def _seen(symbol: str) -> Transducer:
    """State 1 from ``symbol`` to the end of the clause."""
    return Transducer({(0, symbol): 1, (1, None): 1})


NEGATED, REPORTED, TARGETED, THREATENED = _within("neg", 3), _seen("rep"), _seen("tgt"), _within("thr", 4)


def patterns(symbols: list[str], quoted: bool = False) -> Counter:
    """The composed transducers' output for one clause."""
    found, neg, rep, tgt, thr = [], 0, int(quoted), 0, 0
    for x in symbols:
        if x == "ins":
            found.append("negated" if neg else "reported" if rep else "plain")
        elif x == "tgt" and thr:
            found.append("negated" if neg else "reported" if rep else "threat")
        thr = 0 if neg and x == "thr" else THREATENED.step(thr, x)
        neg, rep, tgt = NEGATED.step(neg, x), REPORTED.step(rep, x), TARGETED.step(tgt, x)
    return Counter("aimed" if tgt and f == "plain" else f for f in found)


@dataclass
class Grammar:
    """Insult words, insult stems (a trailing ``*``) and the weight (log odds) of
    each pattern."""

    insults: list[str] = field(default_factory=lambda: list(INSULTS))
    weights: dict[str, float] = field(default_factory=lambda: {k: math.log(p / (1 - p)) for k, p in PRIOR.items()})

    def __post_init__(self) -> None:
        self.symbol = {w: s for s, ws in (("rep", REPORTS), ("tgt", TARGETS), ("neg", NEGATIONS), ("thr", THREATS), ("ins", self.insults)) for w in ws}
        self.finder = ahocorasick.Automaton()
        # a word and a stem may be spelled alike: the automaton keeps one value for a key
        alike: dict[str, list[str]] = {}
        for w in dict.fromkeys((*THREATS, *self.insults)):
            alike.setdefault(w.rstrip("*"), []).append(w)
        for key, entries in alike.items():
            self.finder.add_word(key, (len(key), entries))
        self.finder.make_automaton()

    def hits(self, low: str) -> list[tuple[int, str]]:
        """(start, entry) of the words that are entries or start with a stem."""
        out = []
        for e, (n, entries) in self.finder.iter(low):
            at = e + 1 - n
            if not (at and low[at - 1].isalpha()):
                ends = not low[e + 1 : e + 2].isalpha()
                out += [(at, w) for w in entries if ends or w[-1] == "*"]
        return out

    def matches(self, text: str) -> Counter:
        """How many patterns of each kind a text's clauses hold. Only clauses
        with an insult or a threatening verb are read word by word."""
        low = text.lower()
        hits = self.hits(low)
        if not hits:
            return Counter()
        insulting = {at for at, w in hits if self.symbol[w] == "ins"}
        ends = [m.start() for m in CLAUSE_END.finditer(low)]
        out: Counter = Counter()
        for k in sorted({bisect_right(ends, at) for at, _ in hits}):
            start = ends[k - 1] + 1 if k else 0
            clause = low[start : ends[k] if k < len(ends) else len(low)]
            quoted = clause.lstrip()[:1] in tuple("\"'“«„")
            out += patterns(["ins" if start + m.start() in insulting else self.symbol.get(m[0], "oth") for m in WORD.finditer(clause)], quoted)
        return out

    def strongest(self, text: str) -> str:
        found = self.matches(text)
        return next((p for p in PRIOR if found.get(p)), "none")

    def score(self, text: str) -> float:
        """The strongest pattern's log odds, and a little more for each further
        one, as a probability; without a match those of the pattern ``none``."""
        found = self.matches(text)
        kinds = [p for p in PRIOR if found.get(p)]
        if not kinds:
            return 1 / (1 + math.exp(-self.weights["none"]))
        top = max(self.weights[p] for p in kinds)
        more = sum(max(0.0, self.weights[p]) * found[p] for p in kinds) - max(0.0, top)
        return 1 / (1 + math.exp(-min(30.0, top + 0.1 * more)))


def _known(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the usable labels, ids once."""
    return labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))


def _labelled(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(text, toxic, copy) of the sampled rows, near copies once."""
    part = [known.where(F.col("toxic") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for v, n in SAMPLE.items()]
    # a bounded number of rows of two numbers: the texts need not move
    rows = docs.join(F.broadcast(part[0].unionByName(part[1])), "doc_id").select("doc_id", "text", "toxic")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (s for whole in batches for s in slices(whole)):
            copies = []
            for t in b["text"].to_pylist():
                ws = t.split()
                copies.append(min((xxhash.xxh64_intdigest(" ".join(ws[i : i + 5]).encode("utf-8", "surrogatepass")) >> 1 for i in range(max(1, len(ws) - 4)))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(copies, pa.int64())], [*b.schema.names, "copy"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    copies = rows.mapInArrow(keyed, f"doc_id {kind}, text string, toxic int, copy long").groupBy("toxic", "copy")
    return cut_lineage(copies.agg(F.min(F.struct("doc_id", "text")).alias("row")).select("row.text", "toxic"), "toxic-sample")


def _candidates(rows: DataFrame, bad: int, good: int) -> list[str]:
    """The words and stems that are significantly more frequent in toxic texts."""

    def word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (s for whole in batches for s in slices(whole, 1024)):
            out: Counter = Counter()
            for text, toxic in zip(b["text"].to_pylist(), b["toxic"].to_pylist(), strict=True):
                out.update((w, toxic) for w in set(WORD.findall(text.lower())))
            keys = list(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array(list(out.values()), pa.int64())], ["word", "toxic", "n"]
            )

    words = rows.mapInArrow(word_rows, "word string, toxic int, n long").groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("b"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("g")
    )
    stems = [F.when(F.length("word") > n, F.concat(F.substring("word", 1, n), F.lit("*"))) for n in STEM]
    entries = words.select(F.explode(F.array_compact(F.array(F.col("word"), *stems))).alias("entry"), "b", "g").groupBy("entry").agg(F.sum("b").alias("b"), F.sum("g").alias("g"))
    n, share = F.col("b") + F.col("g"), bad / (bad + good)
    g_test = 2 * (F.col("b") * F.log(F.col("b") / (n * share)) + F.when(F.col("g") > 0, F.col("g") * F.log(F.col("g") / (n * (1 - share)))).otherwise(0))
    found = (
        entries.where((F.col("b") > 0) & (F.col("b") * good > MIN_RATIO * bad * F.col("g")) & (F.length("entry") > 2))
        .withColumn("test", g_test)
        .where(F.col("test") >= MIN_G)
    )
    # words of the sample only
    return sorted(r["entry"] for r in found.select("entry").collect())


def _cover(rows: DataFrame, candidates: list[str], clean_weight: float = 1.0) -> list[str]:
    """Greedy cover of the toxic texts by candidates; a candidate is kept while
    it explains more unexplained toxic texts than 2 and than it hits clean ones.
    A sampled clean text counts as ``clean_weight`` toxic ones."""
    probe = Grammar(candidates)

    def hit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (s for whole in batches for s in slices(whole)):
            found = [sorted({w for _, w in probe.hits(t.lower())}) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["toxic"], pa.array(found, pa.list_(pa.string()))], ["toxic", "found"])

    by_word: dict[str, tuple[set, set]] = {}
    # at most the sample's rows, with candidates only
    for k, r in enumerate(rows.mapInArrow(hit, "toxic int, found array<string>").where("size(found) > 0").collect()):
        for w in r["found"]:
            by_word.setdefault(w, (set(), set()))[r["toxic"]].add(k)
    left, kept = {k for _, bad in by_word.values() for k in bad}, []
    names = sorted(by_word, reverse=True)

    def gain(i: int) -> float:
        good, bad = by_word[names[i]]
        return len(bad & left) - 2 * clean_weight * len(good)

    # gains only fall, so an entry that still has its old gain at the top is the best one
    heap = [(-gain(i), i) for i in range(len(names))]
    heapq.heapify(heap)
    while heap and -heap[0][0] >= 3:
        i = heap[0][1]
        if (now := gain(i)) != -heap[0][0]:
            heapq.heapreplace(heap, (-now, i))
            continue
        heapq.heappop(heap)
        kept.append(names[i])
        left -= by_word[names[i]][1]
    return kept


def learn(docs: DataFrame, labels: DataFrame) -> Grammar:
    """Fits a grammar on labelled rows: ``docs`` (doc_id, text) and ``labels``
    (doc_id, toxic). An id labelled more than once counts as toxic if any says
    so; null labels are ignored."""
    known = _known(labels)
    labelled = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    # labelled rows for each sampled one
    share = {v: max(1.0, labelled.get(v, 0) / most) for v, most in SAMPLE.items()}
    rows = _labelled(docs, known)
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    insults = list(INSULTS)
    if n.get(1) and n.get(0) and (found := _candidates(rows, n[1], n[0])):
        insults = list(dict.fromkeys([*INSULTS, *_cover(rows, found, share[0] / share[1])]))
    grammar = Grammar(insults)

    def strongest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([grammar.strongest(t) for t in b["text"].to_pylist()], pa.string()), b["toxic"]], ["pattern", "toxic"])

    counts = {(r["pattern"], r["toxic"]): r["n"] for r in rows.mapInArrow(strongest, "pattern string, toxic int").groupBy("pattern", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    # in the labels' true ratio, but not more rows than were read: the priors keep their say
    scale = sum(n.get(v, 0) for v in share) / (sum(n.get(v, 0) * share[v] for v in share) or 1)
    weights = {}
    for p, prior in PRIOR.items():
        up, down = (counts.get((p, v), 0) * share[v] * scale + PRIOR_ROWS * q for v, q in ((1, prior), (0, 1 - prior)))
        weights[p] = math.log(up / down)
    return Grammar(insults, weights)


def score(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for every row of ``docs``."""
    rows = texts(docs, id_col, text_col)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([grammar.score(t.as_py()) for t in b["text"]], pa.float64())], ["doc_id", "score"])

    return rows.mapInArrow(scored, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def keep_clean(docs: DataFrame, grammar: Grammar, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that score below 0.5."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([grammar.score(t.as_py() or "") < 0.5 for t in b[text_col]], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
