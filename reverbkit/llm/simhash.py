"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint's 64 bits are cut into segments of 23, 23 and 18 bits. Three
differing bits leave two segments with at most one differing bit each, so two
fingerprints within three bits agree, in at least one pair of segments, on a
codeword of the perfect (23, 12, 7) Golay code near both: the codeword that one
segment decodes to is found among the codewords that the other segment, or the
other segment with one bit turned, decodes to (one or six of them). Every
fingerprint is *indexed* under three keys (pair of segments, two codewords) and
*probes* about 28 keys for each of the three pairs; both meet on the key and
the Hamming distance is checked. The pigeonhole argument holds for up to
three bits, so ``max_bits`` may not be larger.

Work is done on distinct fingerprints. A key with many fingerprints is met in
salted blocks that return a spanning forest, not all their pairs.

Defined results: null and empty texts, and texts without words, have the
fingerprint zero and link like any other. Repeated rows each get a row, with
the same component. A null doc_id never becomes a component's id unless all
ids of the component are null. An empty table gives an empty result. Other
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reverbkit.llm.common import block_groups, cut_lineage, slices, texts
from reverbkit.llm.graph import components

SEGMENTS = ((0, 23), (23, 23), (46, 18))  # first bit, bits
PAIRS = ((0, 1), (0, 2), (1, 2))
GENERATOR = 0xC75  # of the binary Golay code: x^11+x^10+x^6+x^5+x^4+x^2+1
COLD_KEY = 64  # fingerprints under one key that are met by a plain join
BLOCK = 1024  # fingerprints in a block of a larger key


def fingerprint(text: str, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text (see the module's contract), unsigned."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    total, m = np.zeros(64, np.int64), n - shingle + 1
    starts, ends = starts[:m].tolist(), ends[shingle - 1 :].tolist()
    for at in range(0, m, 65536):
        h = np.array([digest(joined[s:e], 42) for s, e in zip(starts[at : at + 65536], ends[at : at + 65536], strict=True)], "<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > m, bitorder="little").tobytes(), "little")


@cache
def golay_index() -> np.ndarray:
    """For each 23-bit word the index (its 12 upper bits) of the one codeword
    within three bits of it."""
    words = np.arange(4096, dtype=np.int64) << 11
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    codewords = words | rest
    errors = np.array([sum(1 << b for b in c) for r in range(4) for c in combinations(range(23), r)], np.int64)
    table, numbers = np.empty(1 << 23, np.int16), np.arange(4096, dtype=np.int16)
    for e in errors:
        table[codewords ^ e] = numbers
    return table


def _segments(fp: np.ndarray) -> list[np.ndarray]:
    return [(fp.view(np.uint64) >> np.uint64(at)).astype(np.int64) & ((1 << n) - 1) for at, n in SEGMENTS]


def _near(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The codewords of each value and of the value with one bit turned, sorted,
    with a mask of the first of equal ones."""
    turned = values[:, None] ^ np.concatenate(([0], 1 << np.arange(bits)))[None, :]
    near = np.sort(golay_index()[turned].astype(np.int64), axis=1)
    first = np.ones(near.shape, bool)
    first[:, 1:] = near[:, 1:] != near[:, :-1]
    return near, first


def _keyed(fp: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(fp, pa.int64()), pa.array(key, pa.int64())], ["fp", "key"])


def _index_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(fp) -> (fp, key): the three keys that a fingerprint is found under."""
    for b in batches:
        fp = b["fp"].to_numpy()
        word = [golay_index()[x].astype(np.int64) for x in _segments(fp)]
        for p, (i, j) in enumerate(PAIRS):
            yield _keyed(fp, p << 24 | word[i] << 12 | word[j])


def _probe_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(fp) -> (fp, key): the keys that a fingerprint asks."""
    for b in (s for whole in batches for s in slices(whole, 2048)):
        fp = b["fp"].to_numpy()
        near = [_near(x, n) for x, (_, n) in zip(_segments(fp), SEGMENTS, strict=True)]
        for p, (i, j) in enumerate(PAIRS):
            row, x, y = np.nonzero(near[i][1][:, :, None] & near[j][1][:, None, :])
            yield _keyed(fp[row], p << 24 | near[i][0][row, x] << 12 | near[j][0][row, y])


def _forest(max_bits: int):
    def match(table: pa.Table) -> pa.Table:
        """A spanning forest of one group's links: (u, v), v the smallest found."""
        fps = table["fp"].to_numpy()
        left = np.unique(fps[table["_left"].to_numpy(zero_copy_only=False)])
        nodes, back = np.unique(np.concatenate((left, fps)), return_inverse=True)
        li, label = back[: len(left)], np.arange(len(nodes))
        bits = nodes.view(np.uint64)
        near = [np.nonzero(np.bitwise_count(bits[i] ^ bits) <= max_bits)[0] for i in li]
        changed = True
        while changed:
            before = label.copy()
            for i, js in zip(li, near, strict=True):
                label[js] = np.minimum(label[js], m := label[js].min())
                label[i] = min(label[i], m)
            changed = not np.array_equal(before, label)
        return pa.table({"u": nodes, "v": nodes[label]})

    return match


def links(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column ``fp``, signed long)
    at ``max_bits`` or fewer differing bits: enough of them that whatever is
    reachable by all links is reachable by these."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the segments' pigeonhole holds for 0 to 3 bits")
    kind = "fp long, key long"
    index = prints.mapInArrow(_index_keys, kind)
    # written once: cold and hot keys are asked by the same probes
    probes = cut_lineage(prints.mapInArrow(_probe_keys, kind), "simhash-probes")
    counts = index.groupBy("key").count()
    index = cut_lineage(index.join(counts, "key"), "simhash-index")
    cold = index.where(F.col("count") <= COLD_KEY).select("key", F.col("fp").alias("u"))
    # merge joins: Spark takes the 28 probes of a fingerprint and pair for one row and would broadcast them
    met = cold.hint("merge").join(
        probes.withColumnRenamed("fp", "v"),
        (cold["key"] == probes["key"]) & (F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits),
    ).select("u", "v")
    hot = index.where(F.col("count") > COLD_KEY).select("key", "fp")
    crowd = probes.select("key", "fp").hint("merge").join(hot.select("key").distinct(), "key")
    return met.unionByName(block_groups(hot, crowd, "key", "fp", BLOCK, _forest(max_bits), "u long, v long"))


def simhash_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (s for whole in batches for s in slices(whole)):
            fp = np.array([fingerprint(t, shingle) for t in b["text"].to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(fp)], ["doc_id", "fp"])

    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = cut_lineage(rows.mapInArrow(prints, f"doc_id {kind}, fp long"), "simhash")
    least = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    reach = components(links(least.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    named = least.join(reach, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    ids = named.groupBy("label").agg(F.min("least").alias("component_id"))
    by_print = cut_lineage(named.join(ids, "label").select("fp", "component_id"), "simhash-components")
    return rows.join(by_print, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
