"""Approximate nearest neighbours by stable projections and a kd-tree.

The largest inner product is the smallest distance once every candidate x gets
the extra coordinate sqrt(M^2 - |x|^2) (M: the largest norm) and every query
the coordinate 0. ``PROJECTED`` Gaussian (2-stable) projections turn a distance
d into a projected one whose square, divided by d^2, is chi-square distributed
with ``PROJECTED`` degrees of freedom (Sun et al., "SRS", 2014).

The index is a kd-tree over the projections. Its upper levels, fitted on a
sample of about ``SAMPLE`` rows, deal all candidates to cells; its lower levels
are built cell by cell where the cell is searched. A query first searches the
nearest cell, which gives it a k-th score, and then only those cells that the
stopping test does not rule out with that score: a cell or leaf at projected
distance p is left out when chi2_cdf(p^2 / d_k^2) >= ``CONFIDENCE``, as a point
there that is nearer than the k-th found would most likely have a smaller
projected distance. Within a cell leaves come by increasing projected distance,
and the test is repeated with every better k-th score. Inner products of a leaf
and all queries that ask for it are one matrix product; what may be among the k
best is then computed again, row by row, so that equal vectors tie.

Every candidate is indexed. A cell with many rows is dealt over blocks, so
memory per task is bounded by the block sizes. Where the vectors have no
structure, distances hardly differ, few cells are ruled out and the work grows
with queries times candidates. On ties the smaller vec_id is first.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part; a query meets only vectors of its own length; rows
with the query's own vec_id are no candidates; repeated candidate rows are
results of their own, of repeated query rows the one with the smallest vector
is asked; fewer candidates than k give them all; an empty table gives an empty
result. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from reverbkit.llm.common import block_groups, cut_lineage, finite, matrix, slices

PROJECTED = 8
CONFIDENCE = 0.99
LEAF = 64
STEP = 8  # leaves verified between two stopping tests
CELL = 4096
SAMPLE = 65_536
BLOCK = 8192
QUERY_BLOCK = 512
PAIRS = 16_384  # pairs computed row by row at a time


def chi2_cdf(x: float, degrees: int = PROJECTED) -> float:
    """For an even number of degrees of freedom."""
    term, total = 1.0, 1.0
    for i in range(1, degrees // 2):
        term *= x / 2 / i
        total += term
    return 1 - exp(-min(x / 2, 700.0)) * total


def chi2_quantile(share: float, degrees: int = PROJECTED) -> float:
    low, high = 0.0, 1e3
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, degrees) < share else (low, mid)
    return high


def kd_leaves(points: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """The rows of a kd-tree's leaves: halves at the median of the widest
    coordinate until a leaf's size is reached."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            out.append(rows)
            continue
        p = points[rows]
        axis = int((p.max(0) - p.min(0)).argmax())
        half = len(rows) // 2
        order = np.argpartition(p[:, axis], half)
        todo += [rows[order[:half]], rows[order[half:]]]
    return out


def kd_splits(points: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(axis, threshold) of the inner nodes of a tree of ``depth`` levels; the
    children of node i are 2 i + 1 and, above the threshold, 2 i + 2."""
    axis, above = np.zeros(2**depth - 1, np.int64), np.zeros(2**depth - 1)
    held = {0: points}
    for node in range(len(axis)):
        p = held.pop(node)
        if len(p):
            axis[node] = (p.max(0) - p.min(0)).argmax()
            above[node] = np.median(p[:, axis[node]])
        right = p[:, axis[node]] > above[node]
        held[2 * node + 1], held[2 * node + 2] = p[~right], p[right]
    return axis, above


def kd_cells(points: np.ndarray, axis: np.ndarray, above: np.ndarray) -> np.ndarray:
    """The cell of each point."""
    node = np.zeros(len(points), np.int64)
    for _ in range(len(axis).bit_length()):
        node = 2 * node + 1 + (points[np.arange(len(points)), axis[node]] > above[node])
    return node - len(axis)


def box_gaps(p: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points to boxes."""
    gap = np.zeros((len(p), len(low)))
    for i in range(p.shape[1]):
        c = p[:, i, None]
        gap += np.maximum(0, np.maximum(low[:, i] - c, c - high[:, i])) ** 2
    return gap


def _project(x: np.ndarray, extra: np.ndarray | float, seed: int) -> np.ndarray:
    directions = np.random.default_rng(seed).standard_normal((x.shape[1] + 1, PROJECTED))
    return x @ directions[:-1] + np.reshape(extra, (-1, 1)) * directions[-1]


def _lifted(x: np.ndarray, largest: float, seed: int) -> np.ndarray:
    """Projections of candidates."""
    return _project(x, np.sqrt((largest**2 - np.einsum("ij,ij->i", x, x)).clip(0)), seed)


def _ruled_out(gap: np.ndarray, norm2: np.ndarray, floor: np.ndarray, largest: float) -> np.ndarray:
    """The stopping test; ``floor`` is the k-th score, -inf if there is none yet."""
    d2 = (largest**2 + norm2 - 2 * floor).clip(0)
    return (gap >= chi2_quantile(CONFIDENCE) * d2) & (gap > 1e-9 * largest**2)


def _by_size(df: DataFrame, made: Callable, column: str, kind: str) -> DataFrame:
    """``df`` with a column ``made(x, rows)`` of its matrix, vectors of one size at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (s for whole in batches for s in slices(whole, 2048)):
            sizes = b["size"].to_numpy()
            for size in np.unique(sizes):
                rows = b.filter(pa.array(sizes == size))
                yield pa.RecordBatch.from_arrays([*rows.columns, made(matrix(rows["vec"]), rows)], [*rows.schema.names, column])

    schema = T.StructType(df.schema.fields + T.StructType.fromDDL(f"{column} {kind}").fields)
    return df.mapInArrow(run, schema)


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(rows) if rows else [], kind))


def _best(of: np.ndarray, value: np.ndarray, number: np.ndarray, k: int) -> np.ndarray:
    """The places of the k best of each query in ``of``, query by query."""
    order = np.lexsort((number, -value, of))
    first = np.searchsorted(of[order], of[order])
    return order[np.arange(len(order)) - first < k]


def _search(k: int, largest: float, seed: int):
    def search(table: pa.Table) -> pa.Table:
        left = table["_left"].to_numpy(zero_copy_only=False)
        ids, x = table["vec_id"], matrix(table["vec"])
        # ids as numbers: nulls are never equal to a query's
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        number = ids.fill_null(0).to_numpy()
        cand, quer = np.nonzero(left)[0], np.nonzero(~left)[0]
        bound = table["bound"].to_numpy(zero_copy_only=False).astype(np.float64)[quer]
        floor = np.where(np.isnan(bound), -np.inf, bound)
        norm2 = np.einsum("ij,ij->i", x[quer], x[quer])
        slack = 1e-12 * largest * np.sqrt(norm2) * x.shape[1]
        shown = _lifted(x[cand], largest, seed)
        leaves = kd_leaves(shown)
        gap = box_gaps(_project(x[quer], 0.0, seed), np.array([shown[r].min(0) for r in leaves]), np.array([shown[r].max(0) for r in leaves]))
        order = gap.argsort(1, kind="stable")
        # the best so far: place of the query in quer, row, score
        of, row, value = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        active = np.arange(len(quer))
        # the first leaf alone: it gives a bound for the others
        for at, end in zip([0, *range(1, len(leaves), STEP)], [1, *range(1 + STEP, len(leaves) + STEP, STEP)], strict=False):
            active = active[~_ruled_out(gap[active, order[active, at]], norm2[active], floor[active], largest)]
            if not len(active):
                break
            asked = order[active, at:end]
            hits = []
            for leaf in np.unique(asked):
                qs = active[(asked == leaf).any(1)]
                rows = cand[leaves[leaf]]
                r, q = np.nonzero(x[rows] @ x[quer[qs]].T >= floor[qs] - slack[qs])
                r, q = rows[r], qs[q]
                other = (number[r] != number[quer[q]]) | ~known[r]
                hits.append((q[other], r[other]))
            q, r = (np.concatenate(h) for h in zip(*hits, strict=True))
            exact = [np.einsum("ij,ij->i", x[r[i : i + PAIRS]], x[quer[q[i : i + PAIRS]]]) for i in range(0, len(r), PAIRS)]
            of, row, value = np.concatenate((of, q)), np.concatenate((row, r)), np.concatenate((value, *exact))
            keep = _best(of, value, number[row], k)
            of, row, value = of[keep], row[keep], value[keep]
            full = np.bincount(of, minlength=len(quer)) == k
            last = np.searchsorted(of, np.arange(len(quer)), "right") - 1
            floor[full] = np.maximum(floor[full], value[last[full]])
        return pa.table({"query_id": ids.take(pa.array(quer[of])), "vec_id": ids.take(pa.array(row)), "score": value})

    return search


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``vectors`` where
    ``is_query`` (over vec_id) holds, its ``k`` nearest found."""
    rows = finite(vectors, id_col, vector_col).where("ok").drop("ok").withColumn("size", F.size("vec")).withColumn("row", F.xxhash64("vec_id", "vec"))
    kind = rows.schema["vec_id"].dataType.simpleString()
    norm = F.sqrt(F.expr("aggregate(vec, 0d, (s, x) -> s + cast(x as double) * x)"))
    largest, n = rows.agg(F.max(norm), F.count(F.lit(1))).first()
    if largest is None:
        return rows.sparkSession.createDataFrame([], T.StructType.fromDDL(f"query_id {kind}, rank int, vec_id {kind}, score double"))
    largest = float(largest)

    def shown(x: np.ndarray, _: pa.RecordBatch) -> pa.Array:
        return _lists(list(_lifted(x, largest, seed)), pa.float64())

    # cells of about CELL rows, and at least 16 sampled rows for each of them
    depth = min(max(0, (n - 1) // CELL).bit_length(), (SAMPLE // 16).bit_length() - 1)
    points = np.zeros((0, PROJECTED))
    if depth:
        sampled = rows.where(F.pmod("row", F.lit(max(1, n // SAMPLE))) == 0).limit(2 * SAMPLE).select("vec", "size")
        points = np.array([r["shown"] for r in _by_size(sampled, shown, "shown", "array<double>").select("shown").collect()]).reshape(-1, PROJECTED)
    splits = kd_splits(points, depth)

    def cells(_: np.ndarray, b: pa.RecordBatch) -> pa.Array:
        p = b["shown"].flatten().to_numpy().reshape(-1, PROJECTED)
        return pa.array(kd_cells(p, *splits), pa.int64())

    placed = cut_lineage(_by_size(_by_size(rows, shown, "shown", "array<double>"), cells, "cell", "long"), "ann-cells")
    sides = [f(F.col("shown")[i]).alias(f"{s}{i}") for s, f in (("low", F.min), ("high", F.max)) for i in range(PROJECTED)]
    # one row per cell
    boxes = placed.groupBy("cell").agg(*sides).orderBy("cell").collect()
    names = np.array([r["cell"] for r in boxes])
    low, high = (np.array([[r[f"{s}{i}"] for i in range(PROJECTED)] for r in boxes]) for s in ("low", "high"))

    def home(x: np.ndarray, _: pa.RecordBatch) -> pa.Array:
        return pa.array(names[box_gaps(_project(x, 0.0, seed), low, high).argmin(1)])

    def others(x: np.ndarray, b: pa.RecordBatch) -> pa.Array:
        floor = b["bound"].fill_null(-np.inf).to_numpy()
        out = _ruled_out(box_gaps(_project(x, 0.0, seed), low, high), np.einsum("ij,ij->i", x, x)[:, None], floor[:, None], largest)
        out |= b["home"].to_numpy()[:, None] == names
        return _lists([names[~o] for o in out], pa.int64())

    # a cell holds vectors of several sizes; they never meet
    key = F.concat_ws(":", "size", "cell").alias("key")
    columns = ["vec_id", "vec", "row", key, "bound"]
    candidates = placed.withColumn("bound", F.lit(None).cast("double")).select(*columns)
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min("vec").alias("vec")).withColumn("size", F.size("vec")).withColumn("row", F.xxhash64("vec_id", "vec"))
    queries = cut_lineage(_by_size(queries, home, "home", "long"), "ann-queries")
    schema = f"query_id {kind}, vec_id {kind}, score double"
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def searched(asked: DataFrame) -> DataFrame:
        return block_groups(candidates, asked.select(*columns), "key", "row", BLOCK, _search(k, largest, seed), schema, QUERY_BLOCK)

    near = searched(queries.withColumn("cell", F.col("home")).withColumn("bound", F.lit(None).cast("double")))
    near = cut_lineage(near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).drop("rank"), "ann-home")
    bounds = near.groupBy(F.col("query_id").alias("vec_id")).agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("bound"))
    asked = _by_size(queries.join(bounds, "vec_id", "left"), others, "cells", "array<long>").withColumn("cell", F.explode("cells"))
    found = near.unionByName(searched(asked))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
