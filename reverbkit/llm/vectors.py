"""Embedding near-dedup: an exact metric range join by cosine.

On unit vectors a cosine of at least c is a Euclidean distance of at most
r = sqrt(2 - 2c). ``PIVOTS`` vectors (those whose hashes are lowest) partition
all vectors: each is at home in the cell of its nearest pivot, and visits the
cell of another pivot only if a vector there can be within r. By the triangle
inequality that needs d(x, other) - d(x, nearest) <= 2r, and because the space
is Euclidean also that x is within r of the plane halfway between both pivots.
A pair of different cells meets in the one with the larger number, so each pair
is seen once. Cells join independently: home rows against home rows and
visitors, in salted blocks of at most ``BLOCK`` rows on each side, so a cell
that holds a third of all vectors is many groups.

Work is done on distinct vectors with their numbers of copies. A group returns
one row per vector (partial link counts and the smallest neighbour found), never
pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing and are kept; vectors of different lengths don't
link; repeated rows are vectors of their own (linked with each other); an empty
table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reverbkit.llm.common import block_groups, cut_lineage, finite, matrix
from reverbkit.llm.graph import components

PIVOTS = 32
BLOCK = 8192
SLACK = 1e-9  # on distances, for rounding


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(1, keepdims=True, initial=0.0).clip(1e-300)
    return m / np.linalg.norm(m, axis=1, keepdims=True).clip(1e-300)


def _cells(pivots: np.ndarray, radius: float):
    apart = np.sqrt((2 - 2 * pivots @ pivots.T).clip(0))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            c = _unit(matrix(b["vec"], pivots.shape[1])) @ pivots.T
            home, row = c.argmax(1), np.arange(len(c))
            nearest, d = c[row, home][:, None], np.sqrt((2 - 2 * c).clip(0))
            far = apart[home]
            near = (d - d[row, home][:, None] <= 2 * radius + SLACK) & ((nearest - c) <= (radius + SLACK) * far + SLACK)
            near &= np.arange(len(pivots))[None, :] >= home[:, None]
            near[row, home] = True
            at, cell = np.nonzero(near)
            names = ["node", "n", "vec", "cell", "home"]
            yield pa.RecordBatch.from_arrays([b[k].take(pa.array(at)) for k in names[:3]] + [pa.array(cell.astype(np.int32)), pa.array(cell == home[at])], names)

    return cells


def _match(cosine: float):
    def match(table: pa.Table) -> pa.Table:
        """Partial link counts and the smallest reachable node of one group."""
        left = table["_left"].to_numpy(zero_copy_only=False)
        node, n, home = table["node"].to_numpy(), table["n"].to_numpy(), table["home"].to_numpy(zero_copy_only=False)
        size = np.array([len(x) for x in table["vec"].to_numpy()])
        unit = _unit(matrix(table["vec"]))
        nodes, back = np.unique(node, return_inverse=True)
        links, label, near = np.zeros(len(nodes), np.int64), np.arange(len(nodes)), []
        lefts, rights = np.nonzero(left)[0], np.nonzero(~left)[0]
        for at in range(0, len(lefts), 512):
            ls = lefts[at : at + 512]
            hit = unit[ls] @ unit[rights].T >= cosine
            hit &= (node[ls][:, None] != node[rights][None, :]) & (size[ls][:, None] == size[rights][None, :])
            for k in np.nonzero(hit.any(1))[0]:
                rs = rights[hit[k]]
                links[back[ls[k]]] += n[rs].sum()
                # two vectors at home here meet in both orders, a visitor only in this one
                np.add.at(links, back[rs[~home[rs]]], n[ls[k]])
                near.append((back[ls[k]], back[rs]))
        changed = True
        while changed:
            before = label.copy()
            for i, js in near:
                low = min(label[i], label[js].min())
                label[i] = low
                label[js] = np.minimum(label[js], low)
            changed = not np.array_equal(before, label)
        some = links > 0
        return pa.table({"node": nodes[some], "links": links[some], "label": nodes[label[some]]})

    return match


def near_vectors(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``."""
    rows = finite(vectors, id_col, vector_col)
    distinct = rows.where("ok").groupBy("vec").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    # written once, so that the numbering stays as it is
    distinct = cut_lineage(distinct.withColumn("node", F.monotonically_increasing_id()), "vectors")
    chosen = distinct.orderBy(F.xxhash64("vec"), "least").limit(PIVOTS).select("vec").collect()
    everyone = rows.select("vec_id", F.when(F.col("ok"), F.col("vec")).alias("vec"))
    if not chosen:
        return everyone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    width = distinct.agg(F.max(F.size("vec"))).first()[0]
    pivots = np.zeros((len(chosen), width))
    for p, r in zip(pivots, chosen, strict=True):
        p[: len(r["vec"])] = r["vec"]
    kind = distinct.schema["vec"].dataType.simpleString()
    radius = float(np.sqrt(2 - 2 * cosine))
    placed = cut_lineage(
        distinct.select("node", "n", "vec").mapInArrow(_cells(_unit(pivots), radius), f"node long, n long, vec {kind}, cell int, home boolean"), "cells"
    )
    found = cut_lineage(block_groups(placed.where("home"), placed, "cell", "node", BLOCK, _match(cosine), "node long, links long, label long"), "near")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    reach = components(found.select(F.col("node").alias("u"), F.col("label").alias("v"))).select("node", "label")
    named = distinct.select("vec", "n", "least", "node").join(links, "node", "left").join(reach, "node", "left")
    named = named.withColumn("label", F.coalesce("label", "node"))
    ids = named.groupBy("label").agg(F.min("least").alias("component_id"))
    by_vector = cut_lineage(
        named.join(ids, "label").select("vec", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"), "vector-components"
    )
    out = everyone.join(by_vector, "vec", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
