"""Text embeddings learned from co-occurrence (M5): a truncated eigendecomposition of
the positive pointwise mutual information of terms, by subspace iteration in Spark.

* Terms that stand at most ``window`` apart in a text are a pair; pairs and their
  marginals are keyed aggregates with map-side combine;
* the symmetric matrix is kept by one half, packed in arrays;
* a round multiplies it with ``dims`` vectors, kept as a table (term, vec), cell by
  cell of a triangle that keeps a cell at about ``CELL`` pairs;
* only ``dims x dims`` numbers reach the driver: Gram matrices, for a Cholesky
  orthonormalisation per round and the small eigenproblem at the end;
* a text's vector is the sum of its terms' vectors, weighted by ``idf``.

The start vectors come from hashes of the terms, so the result depends on the texts and
the seed alone. Signs of the dimensions are fixed by nothing; cosines do not depend on them.

Null and empty texts, and texts without a known term, have the zero vector. A
vocabulary of fewer terms than ``dims`` gives that many dimensions, filled up with
zeros; no terms give an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reverbkit.constants import SEED
from reverbkit.operators.pairing import TERM_PATTERN
from reverbkit.session import cut_lineage

CELL = 4_000_000  # pairs of one cell of the matrix
PART = 200_000  # terms of one part of it
SLICE = 100_000  # pairs multiplied at a time
GROUP = 8_000_000  # characters of one group of texts


def _terms(text: str) -> F.Column:
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(TERM_PATTERN), 0)


def _term_ids(texts: DataFrame, text_col: str, window: int, min_count: int) -> tuple[DataFrame, DataFrame]:
    """((id, term) of the terms of at least ``min_count`` places, (a, b, c) how often two
    of them stand near each other, written once with the smaller id first)."""
    row = cut_lineage(texts.select(_terms(text_col).alias("w")).withColumn("row", F.monotonically_increasing_id()), "texts")
    kept = row.select(F.explode("w").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)
    names = cut_lineage(kept.select(F.xxhash64("term").alias("id"), "term"), "terms")
    known = row.select("row", F.posexplode("w").alias("p", "t")).select("row", "p", F.xxhash64("t").alias("id")).join(names.select("id"), "id")
    told = known.groupBy("row").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "id"))), lambda x: x["id"]).alias("w"))
    ahead = [f"arrays_zip(slice(w, 1, greatest(size(w) - {o}, 0)), slice(w, {o + 1}, greatest(size(w) - {o}, 0)))" for o in range(1, window + 1)]
    pair = told.select(F.explode(F.expr(f"concat({', '.join(ahead)})")).alias("x")).select(F.least("x.0", "x.1").alias("a"), F.greatest("x.0", "x.1").alias("b"))
    return names, cut_lineage(pair.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c")), "pairs")


def _marginals(pairs: DataFrame) -> tuple[DataFrame, float]:
    """((id, s), total): sums of the symmetric matrix that ``pairs`` is one half of. A
    term beside itself counts twice."""
    sides = pairs.select(F.explode(F.array("a", "b")).alias("id"), "c")
    sums = cut_lineage(sides.groupBy("id").agg(F.sum("c").alias("s")), "sums")
    return sums, float(sums.agg(F.sum("s")).first()[0] or 0)


def term_pairs(texts: DataFrame, text_col: str, window: int = 4, min_count: int = 2) -> DataFrame:
    """(a, b, ppmi): terms that stand near each other more often than by chance, in
    both orders. Terms of fewer than ``min_count`` places take no part; they are left out
    before neighbours are looked at."""
    names, pairs = _term_ids(texts, text_col, window, min_count)
    sums, total = _marginals(pairs)
    twice = pairs.select("a", "b", F.when(F.col("a") == F.col("b"), 2 * F.col("c")).otherwise(F.col("c")).alias("c"))
    both = twice.unionByName(twice.where("a != b").select(F.col("b").alias("a"), F.col("a").alias("b"), "c"))
    told = sums.join(names, "id")
    joined = both.join(told.select(F.col("id").alias("a"), F.col("term").alias("ta"), F.col("s").alias("sa")), "a")
    joined = joined.join(told.select(F.col("id").alias("b"), F.col("term").alias("tb"), F.col("s").alias("sb")), "b")
    ppmi = F.log(F.col("c") * total / (F.col("sa") * F.col("sb")))
    return joined.select(F.col("ta").alias("a"), F.col("tb").alias("b"), ppmi.alias("ppmi")).where("ppmi > 0")


def _cells(rows: DataFrame, left: str, right: str, dims: int) -> np.ndarray:
    """Sum over all rows of the outer products of two vector columns: dims x dims numbers."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for b in batches:
            x, y = (b[c].flatten().to_numpy().reshape(b.num_rows, dims) for c in (left, right))
            total += x.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(dims * dims), pa.int32()), pa.array(total.ravel())], ["cell", "x"])

    out = np.zeros(dims * dims)
    for r in rows.select(*dict.fromkeys([left, right])).mapInArrow(cells, "cell int, x double").groupBy("cell").agg(F.sum("x").alias("x")).collect():
        out[r["cell"]] = r["x"]
    return out.reshape(dims, dims)


def _turned(rows: DataFrame, column: str, by: np.ndarray) -> DataFrame:
    """(id, term, vec): the vectors of ``column`` times a dims x dims matrix."""

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b[column].flatten().to_numpy().reshape(b.num_rows, len(by)) @ by
            yield pa.RecordBatch.from_arrays([b["id"], b["term"], pa.array(list(x), pa.list_(pa.float64()))], ["id", "term", "vec"])

    return rows.select("id", "term", column).mapInArrow(turn, "id long, term string, vec array<double>")


def _orthonormal(rows: DataFrame, column: str, dims: int) -> DataFrame:
    """The vectors turned so that their columns are orthonormal; a column that
    depends on the others becomes zero."""
    values, axes = np.linalg.eigh(_cells(rows, column, column, dims))
    scale = np.where(values > max(values.max(initial=0), 0) * 1e-12, 1 / np.sqrt(np.maximum(values, 1e-300)), 0)
    return cut_lineage(_turned(rows, column, axes * scale), "basis")


def _summed(ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids and the sums of their rows."""
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    return ids[first], np.add.reduceat(x[order], first, axis=0)


def _rows(ids: np.ndarray, x: np.ndarray) -> pa.Table:
    return pa.table({"id": pa.array(ids, pa.int64()), "y": pa.array(list(x), pa.list_(pa.float64()))})


def _one(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A column of one row that holds an array."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def _cell_table(pairs: DataFrame, sums: DataFrame, total: float, parts: int) -> DataFrame:
    """(pa, pb, ida, sa, idb, sb, i, j, c), written once: the pairs of positive ppmi in
    rows of at most ``SLICE``, as places i and j in the arrays of their terms' ids and sums.
    Terms are dealt over ``parts`` parts by their ids, and a pair lies in the cell of
    its terms' parts, the smaller part first."""
    schema = "pa int, pb int, ida array<long>, sa array<long>, idb array<long>, sb array<long>, i array<int>, j array<int>, c array<long>"
    kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.int64()]

    def packed(key: tuple, own: pa.Table, part: pa.Table) -> pa.Table:
        rows = []
        if own.num_rows:
            a, b, c = (own[x].to_numpy() for x in ("a", "b", "c"))
            ids, s = part["id"].to_numpy(), part["s"].to_numpy()
            order = np.argsort(ids)
            ids, s = ids[order], s[order]
            i, j = np.searchsorted(ids, a).astype(np.int32), np.searchsorted(ids, b).astype(np.int32)
            keep = np.log(c * total / (s[i].astype(np.float64) * s[j])) > 0
            i, j, c = i[keep], j[keep], c[keep]
            order = np.argsort(i, kind="stable")
            i, j, c = i[order], j[order], c[order]
            for k in range(0, len(i), SLICE):
                (left, at), (right, to) = (np.unique(x[k : k + SLICE], return_inverse=True) for x in (i, j))
                values = ids[left], s[left], ids[right], s[right], at, to, c[k : k + SLICE]
                rows.append(pa.table([pa.array([x.as_py()], pa.int32()) for x in key] + [_one(*x) for x in zip(values, kinds, strict=True)], names))
        return pa.concat_tables(rows) if rows else empty

    names = [x.split()[0] for x in schema.split(", ")]
    empty = pa.table([pa.array([], pa.int32())] * 2 + [pa.array([], pa.list_(k)) for k in kinds], names)
    place = {x: F.pmod(x, F.lit(parts)).cast("int") for x in ("a", "b", "id")}
    turn = place["a"] > place["b"]
    first, second = (F.when(turn, F.col(y)).otherwise(F.col(x)) for x, y in (("a", "b"), ("b", "a")))
    turned = pairs.select(first.alias("a"), second.alias("b"), F.when(F.col("a") == F.col("b"), 2 * F.col("c")).otherwise(F.col("c")).alias("c"))
    own = turned.select(place["a"].alias("pa"), place["b"].alias("pb"), "a", "b", "c")
    return cut_lineage(own.groupBy("pa", "pb").cogroup(_spread(sums, place["id"], parts).groupBy("pa", "pb")).applyInArrow(packed, schema), "cells")


def _spread(rows: DataFrame, place: F.Column, parts: int) -> DataFrame:
    """Each row once for each cell (pa, pb) that its part ``place`` meets."""
    other = rows.withColumn("_own", place).withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return other.select(*rows.columns, F.least("_own", "_other").alias("pa"), F.greatest("_own", "_other").alias("pb"))


def _product(cells: DataFrame, basis: DataFrame, dims: int, parts: int, total: float) -> DataFrame:
    """(id, term, vec, y): each basis row with its row of matrix times basis. A cell of the
    matrix meets both its parts of the basis in one group and gives sums for both; the
    sums of a term are added up."""
    schema = "id long, y array<double>"

    def cell(own: pa.Table, part: pa.Table) -> pa.Table:
        if not own.num_rows or not part.num_rows:
            return _rows(np.zeros(0, np.int64), np.zeros((0, dims)))
        ids = part["id"].to_numpy()
        order = np.argsort(ids)
        ids, q = ids[order], part["vec"].combine_chunks().flatten().to_numpy().reshape(len(ids), dims)[order]
        y = np.zeros_like(q)
        for k in range(own.num_rows):
            ida, sa, idb, sb, i, j, c = (own[x][k].values.to_numpy() for x in ("ida", "sa", "idb", "sb", "i", "j", "c"))
            v = np.log(c * total / (sa[i].astype(np.float64) * sb[j]))[:, None]
            a, b = np.searchsorted(ids, ida), np.searchsorted(ids, idb)
            at, x = _summed(i, v * q[b[j]])
            y[a[at]] += x
            apart = ida[i] != idb[j]  # a term beside itself counts once
            at, x = _summed(j[apart], v[apart] * q[a[i[apart]]]) if apart.any() else (j[:0], np.zeros((0, dims)))
            y[b[at]] += x
        met = y.any(axis=1)
        return _rows(ids[met], y[met])

    def added(table: pa.Table) -> pa.Table:
        y = table["y"].combine_chunks().flatten().to_numpy().reshape(table.num_rows, dims)
        return _rows(*_summed(table["id"].to_numpy(), y))

    spread = _spread(basis.select("id", "vec"), F.pmod("id", F.lit(parts)).cast("int"), parts)
    sums = cells.groupBy("pa", "pb").cogroup(spread.groupBy("pa", "pb")).applyInArrow(cell, schema)
    sums = sums.withColumn("deal", F.pmod(F.xxhash64("id"), F.lit(8 * parts))).groupBy("deal").applyInArrow(added, schema)
    return cut_lineage(basis.join(sums, "id", "left").withColumn("y", F.coalesce("y", F.array_repeat(F.lit(0.0), dims))), "product")


def learn(texts: DataFrame, text_col: str, dims: int = 32, window: int = 4, min_count: int = 2, rounds: int = 6, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """((term, vec) and the eigenvalues, largest first): term vectors scaled by the square roots of
    the eigenvalues; directions of negative ones are left at zero. Inside, terms go by
    their 64-bit hashes."""
    names, pairs = _term_ids(texts, text_col, window, min_count)
    sums, total = _marginals(pairs)
    # parts * (parts + 1) / 2 cells of about CELL pairs
    parts = max(1, math.ceil(math.sqrt(2 * pairs.count() / CELL)), math.ceil(sums.count() / PART))
    cells = _cell_table(pairs, sums, total, parts)
    start = F.expr(f"transform(sequence(1, {dims}), i -> xxhash64(term, i, {int(seed)}) / 9.3e18D)")
    met = cells.select(F.explode("ida").alias("id")).unionByName(cells.select(F.explode("idb").alias("id"))).distinct()
    basis = names.join(met, "id", "left_semi").select("id", "term", start.alias("vec"))
    basis = _orthonormal(basis, "vec", dims)
    for _ in range(rounds):
        basis = _orthonormal(_product(cells, basis, dims, parts, total), "y", dims)
    made = _product(cells, basis, dims, parts, total)
    small = _cells(made, "vec", "y", dims)
    values, axes = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-values)
    values, axes = values[order], axes[:, order]
    return cut_lineage(_turned(made, "vec", axes * np.sqrt(np.maximum(values, 0))).select("term", "vec"), "term-vectors"), values


def text_vectors(texts: DataFrame, keys: list[str], text_col: str, vectors: DataFrame, idf: DataFrame, dims: int, out: str = "vec") -> DataFrame:
    """``texts`` with the column ``out``: the sum of tf * idf * vec over their terms.
    ``keys`` identify a text; ``idf`` has (term, idf). Texts are dealt over groups of about
    ``GROUP`` characters, and a term's vector goes once to each group that holds it."""
    chars = texts.agg(F.sum(F.length(text_col))).first()[0] or 0
    groups = max(1, math.ceil(chars / GROUP))
    dealt = texts.withColumn("_w", _terms(text_col)).withColumn("_g", F.pmod(F.xxhash64(*keys), F.lit(groups)).cast("int"))
    known = vectors.join(idf, "term").select("term", F.transform("vec", lambda x: x * F.col("idf")).alias("_v"))
    asked = dealt.select(F.col("_g").alias("_h"), F.explode("_w").alias("term")).distinct().join(known, "term")
    own = texts.columns

    def summed(rows: pa.Table, part: pa.Table) -> pa.Table:
        x = np.zeros((rows.num_rows, dims))
        if rows.num_rows and part.num_rows:
            w = rows["_w"].combine_chunks()
            v = part["_v"].combine_chunks().flatten().to_numpy().reshape(part.num_rows, dims)
            at = pc.index_in(w.flatten(), value_set=part["term"].combine_chunks())
            of = np.repeat(np.arange(rows.num_rows), pc.list_value_length(w).to_numpy())[at.is_valid().to_numpy(zero_copy_only=False)]
            at = at.drop_null().to_numpy()
            for k in range(0, len(at), SLICE):
                told, part_sums = _summed(of[k : k + SLICE], v[at[k : k + SLICE]])
                x[told] += part_sums
        vec = pa.ListArray.from_arrays(pa.array(np.arange(rows.num_rows + 1) * dims, pa.int32()), pa.array(x.ravel()))
        return rows.select(own).append_column(out, vec)

    schema = T.StructType([*texts.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))])
    return dealt.groupBy("_g").cogroup(asked.groupBy("_h")).applyInArrow(summed, schema)


def inverse_frequency(texts: DataFrame, text_col: str) -> DataFrame:
    """(term, idf): ln((1 + texts) / (1 + texts with the term))."""
    count = texts.agg(F.count(F.lit(1))).scalar()
    terms = texts.select(F.explode(F.array_distinct(_terms(text_col))).alias("term"))
    return terms.groupBy("term").agg(F.log((1 + count) / (1 + F.count(F.lit(1)))).alias("idf"))
