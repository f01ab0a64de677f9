"""Comment <-> transcript-chunk pairing.

The reference builds the full chunk x comment product and then keeps the most
similar chunk per comment. Here the product is never materialised:

* chunks of a video are packed into **blocks** of at most ``block_size``
  chunks (``(chunk_index - 1) div block_size``), so a block is bounded;
* comments meet a block in groups of at most about ``rows_per_salt`` comments, and
  a group is one matrix product (``nearest_chunk``) or, for sparse TF-IDF
  vectors, array functions in each comment x block row;
* a dense search over several blocks first asks the block whose centroid is
  nearest, and then only blocks that could still win (``blocks_left``);
* per-block winners are reduced with ``max(struct(sim, -chunk_index))``,
  a partial (map-side) aggregate, so ties go to the lowest ``chunk_index``.

Hot videos (one video holding a large share of all comments) are split by an
adaptive salt: a key with r comments gets ceil(r / rows_per_salt) salts,
its comment rows are spread over them by ``xxhash64(comment key)`` and its
(small) block side is replicated once per salt, so each group or task
holds about ``rows_per_salt`` comments whatever the skew. Spark chooses
how to join the small table of hot keys.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reverbkit.session import cut_lineage

DEFAULT_BLOCK = 256
DEFAULT_ROWS_PER_SALT = 1_000_000  # comments of one task of the sparse search
DEFAULT_GROUP = 65_536  # comments of one group of the dense search
PACK = 256  # centroids that a comment meets at once
SLICE = 4_096  # comments of one matrix product
TAKEN = 16_384  # comment x block rows made at once
SLACK = 1e-9  # of a bound, for rounding
GROUP_SIZE, GROUP_PAIRS = 1_000_000, 16_000_000  # a video that the sparse search has in one group
BUNDLE_SIZE = 4_000_000  # videos of one group of the sparse search
ROW_SIZE = 64  # what a row counts beside its characters
MET = 2_000_000  # terms of chunks that comments meet at once


def hot_key_salts(comments: DataFrame, key: str, rows_per_salt: int) -> DataFrame:
    """(key, _ns) for keys holding more than ``rows_per_salt`` rows, with
    ``_ns = ceil(rows / rows_per_salt)`` salts. A partial aggregate; the
    result has at most N / rows_per_salt rows."""
    counts = comments.groupBy(key).agg(F.count(F.lit(1)).alias("_cnt"))
    return counts.where(F.col("_cnt") > rows_per_salt).select(
        key, F.ceil(F.col("_cnt") / F.lit(rows_per_salt)).cast("int").alias("_ns")
    )


def _salted(comments: DataFrame, blocks: DataFrame, key: str, comment_key: str,
            rows_per_salt: int = DEFAULT_ROWS_PER_SALT):
    """Comment x block candidates on (key, salt).

    Only hot keys are split: a key with r rows gets ceil(r / rows_per_salt)
    salts, its comment rows are spread over them by hash and its (small)
    block side is replicated once per salt; every other key keeps salt 0.
    """
    hot = hot_key_salts(comments, key, rows_per_salt)
    ns = F.coalesce(F.col("_ns"), F.lit(1))
    c = comments.join(hot, key, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(F.col(comment_key)), ns).cast("int")).drop("_ns")
    b = blocks.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), ns - 1))).drop("_ns")
    return c.join(b, [key, "_salt"], "inner")


# Similarity rounded to 12 places is the ranking key, so float noise in the
# last bits never decides a tie (ties go to the lowest chunk_index).
SQL_RANK = "(floor(({sim}) * 1e12 + 0.5) / 1e12)"


def _best_match(joined: DataFrame, key: str, comment_key: str, sims: str, comment_payload: list[str],
                chunk_payload: list[str]) -> DataFrame:
    """The best chunk per comment from comment x block rows. ``sims`` gives the
    similarities to the block's chunks and is projected once."""
    fields = [f"'rk', {SQL_RANK.format(sim='s_')}", "'neg', -cs[i_].chunk_index",
              "'chunk_index', cs[i_].chunk_index", "'sim', s_"] + [f"'{p}', cs[i_].{p}" for p in chunk_payload]
    best_expr = f"array_max(transform(_sims, (s_, i_) -> named_struct({', '.join(fields)})))"
    best_in_block = joined.select(key, "_salt", comment_key, *comment_payload, "cs", F.expr(sims).alias("_sims")).select(
        key, "_salt", comment_key, *comment_payload, F.expr(best_expr).alias("best"))
    # the salt follows from the comment: grouping by it too keeps the join's partitioning
    best = best_in_block.groupBy(key, "_salt", comment_key).agg(
        F.max("best").alias("best"), *[F.any_value(p).alias(p) for p in comment_payload])
    return best.select(
        key,
        comment_key,
        *comment_payload,
        F.col("best.chunk_index").alias("chunk_index"),
        F.col("best.sim").alias("similarity"),
        *[F.col("best." + p).alias(p) for p in chunk_payload],
    )


# ---------------------------------------------------------------------------
# Dense search: matrix products of bounded groups, and bounds between blocks.
# ---------------------------------------------------------------------------

def _unit_rows(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows of length one; null and zero vectors as zeros. Shorter
    vectors are filled up with zeros."""
    lists = column.combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    width, values = int(sizes.max(initial=0)), lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == width).all():
        out = values.reshape(len(sizes), width)
    else:
        out = np.zeros((len(sizes), width))
        out[np.arange(width)[None, :] < sizes[:, None]] = values
    out = np.nan_to_num(out)
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return np.divide(out, norm, out=np.zeros_like(out), where=norm > 0)


def _products(comments: np.ndarray, chunks: np.ndarray):
    """(first comment, similarities) for a slice of comments at a time."""
    width = max(comments.shape[1], chunks.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (comments, chunks))
    for at in range(0, len(a), SLICE):
        yield at, a[at : at + SLICE] @ b.T


def _ranks(sims: np.ndarray) -> np.ndarray:
    """Similarities as they are ranked (see ``SQL_RANK``)."""
    return np.floor(sims * 1e12 + 0.5) / 1e12


def _meet(comments: DataFrame, chunks: DataFrame, on: list[str], comment_key: str, rows_per_salt: int, found: Callable, schema: T.StructType) -> DataFrame:
    """Groups of the comments and chunks that share the columns ``on``, comments
    dealt over salts. ``found(comments, chunks)`` gets two Arrow tables and yields
    tables, which leave the task one by one."""
    counts = comments.groupBy(*on).agg(F.count(F.lit(1)).alias("_cnt")).where(F.col("_cnt") > rows_per_salt)
    hot = counts.select(*on, F.ceil(F.col("_cnt") / F.lit(rows_per_salt)).cast("int").alias("_ns"))
    ns = F.coalesce("_ns", F.lit(1))
    left = comments.join(hot, on, "left").withColumn("_salt", F.pmod(F.xxhash64(F.col(comment_key)), ns).cast("int")).drop("_ns")
    right = chunks.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), ns - 1))).drop("_ns")
    both = left.withColumn("_left", F.lit(True)).unionByName(right.withColumn("_left", F.lit(False)), allowMissingColumns=True)
    own = [c for c in left.columns if c not in ("_salt",)], [c for c in right.columns if c not in ("_salt",)]

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = [], []
        for batch in batches:
            is_left = batch["_left"]
            sides[0].append(batch.filter(is_left).select(own[0]))
            sides[1].append(batch.filter(pc.invert(is_left)).select(own[1]))
        a, b = map(pa.Table.from_batches, sides)
        sides[0].clear(), sides[1].clear()
        if a.num_rows and b.num_rows:
            for table in found(a, b):
                yield from table.to_batches()

    return both.groupBy(*on, "_salt").applyInArrow(met, schema)


def _nearest_in(comments: DataFrame, chunks: DataFrame, on: list[str], comment_key: str, rows_per_salt: int) -> DataFrame:
    """Each comment's best chunk of the group it is in: the comment's columns but
    its vector, and _rank, _sim, _index and the chunk's payload."""
    carried = [c for c in comments.columns if c != "_v"]
    payload = [c for c in chunks.columns if c not in (*on, "_index", "_w")]
    schema = T.StructType([comments.schema[c] for c in carried])
    schema = schema.add("_rank", "double").add("_sim", "double").add("_index", "integer")
    for c in payload:
        schema = schema.add(chunks.schema[c])

    def found(a: pa.Table, b: pa.Table) -> Iterator[pa.Table]:
        b = b.take(pc.sort_indices(b["_index"]))  # the first of equal ones has the lowest index
        best, sims = [], []
        for _, s in _products(_unit_rows(a["_v"]), _unit_rows(b["_w"])):
            at = _ranks(s).argmax(axis=1)
            best.append(at)
            sims.append(s[np.arange(len(at)), at])
        at, sim = pa.array(np.concatenate(best)), np.concatenate(sims)
        columns = {c: a[c] for c in carried} | {"_rank": pa.array(_ranks(sim)), "_sim": pa.array(sim), "_index": b["_index"].take(at)}
        yield pa.table(columns | {c: b[c].take(at) for c in payload})

    return _meet(comments, chunks, on, comment_key, rows_per_salt, found, schema)


def block_bounds(chunks: DataFrame, key: str) -> DataFrame:
    """(key, _block, _w, _angle, _zero): each block's mean direction, the widest
    angle between it and a chunk (pi where there is no direction), and whether a chunk is a zero vector."""
    schema = T.StructType([chunks.schema[key], chunks.schema["_block"]])
    schema = schema.add("_w", T.ArrayType(T.DoubleType())).add("_angle", "double").add("_zero", "boolean")

    def bound(table: pa.Table) -> pa.Table:
        x = _unit_rows(table["_w"])
        real = x.any(axis=1)
        mean = x.sum(axis=0)
        norm = float(np.sqrt(mean @ mean))
        centre = mean / norm if norm > 1e-9 else np.zeros_like(mean)
        cosine = float((x[real] @ centre).min(initial=1.0)) if norm > 1e-9 else -1.0
        return pa.table({
            key: table[key][:1], "_block": table["_block"][:1], "_w": pa.array([centre], pa.list_(pa.float64())),
            "_angle": pa.array([float(np.arccos(np.clip(cosine, -1, 1)))]), "_zero": pa.array([bool((~real).any())]),
        })

    return chunks.groupBy(key, "_block").applyInArrow(bound, schema)


def blocks_left(comments: DataFrame, bounds: DataFrame, key: str, comment_key: str, rows_per_salt: int = DEFAULT_GROUP) -> DataFrame:
    """``comments`` (with _v, their best rank so far and the block _home it is from)
    once for each other block that may hold a chunk as similar: the angle between a
    comment and any chunk is at least that to the block's direction less the block's angle."""
    packs = bounds.withColumnRenamed("_block", "_index").withColumn("_pack", F.expr(f"_index div {PACK}"))
    asked = comments.join(packs.groupBy(key).agg(F.max("_pack").alias("_last")), key)
    asked = asked.withColumn("_pack", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last")))).drop("_last")
    schema = T.StructType([f for f in asked.schema.fields if f.name != "_pack"]).add("_block", "long")

    def found(a: pa.Table, b: pa.Table) -> Iterator[pa.Table]:
        index, angle, zero = (b[c].to_numpy() for c in ("_index", "_angle", "_zero"))
        a = a.drop(["_pack"])
        home, rank = a["_home"].to_numpy(), a["_rank"].to_numpy()
        for at, s in _products(_unit_rows(a["_v"]), _unit_rows(b["_w"])):
            best = np.cos(np.maximum(np.arccos(np.clip(s, -1, 1)) - angle[None, :], 0))
            best = np.where(zero[None, :], np.maximum(best, 0), best)
            part = slice(at, at + len(s))
            i, k = np.nonzero((best >= rank[part, None] - SLACK) & (index[None, :] != home[part, None]))
            # a comment may be left with every block: its rows go out in bounded tables
            for to in range(0, len(i), TAKEN):
                taken = a.take(pa.array(i[to : to + TAKEN] + at))
                yield taken.append_column("_block", pa.array(index[k[to : to + TAKEN]], pa.int64()))

    return _meet(asked, packs, [key, "_pack"], comment_key, rows_per_salt, found, schema)


def nearest_chunk(comments: DataFrame, chunks: DataFrame, key: str = "video_id",
                  comment_key: str = "comment_id", vec_col: str = "vec",
                  block_size: int = DEFAULT_BLOCK, rows_per_salt: int = DEFAULT_GROUP,
                  comment_payload: list[str] | None = None,
                  chunk_payload: list[str] | None = None) -> DataFrame:
    """The most similar chunk of the same video for every comment.

    Returns ``key, comment_key, chunk_index, similarity`` plus the payload
    columns of the comment and of the winning chunk (carried through the
    search, so no join back is needed). Similarity is the cosine
    ``dot / (|a| |b|)`` (0 for a null or zero vector). Comments whose video has no
    chunk are dropped (inner semantics, as in the reference).

    Videos of one block are searched by one matrix product per group. Of the others a
    comment asks first its home block, whose direction is nearest, and then the
    blocks that ``blocks_left`` cannot exclude. The result is exact.
    """
    comment_payload, chunk_payload = comment_payload or [], chunk_payload or []
    cm = comments.where(F.col(key).isNotNull()).select(key, comment_key, *comment_payload, F.col(vec_col).alias("_v"))
    block = F.floor((F.col("chunk_index") - 1) / block_size).cast("long")
    kc = chunks.select(key, block.alias("_block"), F.col("chunk_index").cast("int").alias("_index"), F.col(vec_col).alias("_w"),
                       *[F.col(p).alias(f"_k_{p}") for p in chunk_payload])
    on = [key, "_block"]
    names = ["_rank", "_sim", "_index", *[f"_k_{p}" for p in chunk_payload]]
    if kc.where("_block > 0").isEmpty():
        found = _nearest_in(cm.withColumn("_block", F.lit(0).cast("long")), kc, on, comment_key, rows_per_salt)
    else:
        kc = cut_lineage(kc, "chunks")
        bounds = cut_lineage(block_bounds(kc, key), "bounds")
        # the home block: the nearest direction, pack by pack
        packs = bounds.select(key, F.expr(f"_block div {PACK}").alias("_pack"), F.col("_block").cast("int").alias("_index"), "_w")
        asked = cm.join(packs.groupBy(key).agg(F.max("_pack").alias("_last")), key)
        asked = asked.withColumn("_pack", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last")))).drop("_last")
        near = _nearest_in(asked.select(key, comment_key, "_pack", "_v"), packs, [key, "_pack"], comment_key, rows_per_salt)
        home = near.groupBy(key, comment_key).agg(F.max(F.struct("_rank", (-F.col("_index")).alias("n"))).alias("b"))
        homed = cut_lineage(cm.join(home.select(key, comment_key, (-F.col("b.n")).cast("long").alias("_block")), [key, comment_key]), "homed")
        first = cut_lineage(_nearest_in(homed, kc, on, comment_key, rows_per_salt), "first")
        so_far = homed.withColumnRenamed("_block", "_home").join(first.select(key, comment_key, "_rank").distinct(), [key, comment_key])
        # the comment's payload is in ``first`` and does not go to every block
        left = blocks_left(so_far.drop(*comment_payload), bounds, key, comment_key, rows_per_salt).drop("_rank", "_home")
        found = first.unionByName(_nearest_in(left, kc, on, comment_key, rows_per_salt), allowMissingColumns=True)
    best = F.struct("_rank", (-F.col("_index")).alias("_neg"), *names[1:])
    rows = found.groupBy(key, comment_key).agg(F.max(best).alias("b"), *[F.any_value(p, F.lit(True)).alias(p) for p in comment_payload])
    return rows.select(key, comment_key, *comment_payload, F.col("b._index").alias("chunk_index"), F.col("b._sim").alias("similarity"),
                       *[F.col(f"b._k_{p}").alias(p) for p in chunk_payload])


def pair_counts(comments: DataFrame, chunks: DataFrame, key: str = "video_id") -> DataFrame:
    """J1 + A8: size of the chunk x comment product per video, without building it."""
    nc = comments.groupBy(key).agg(F.count(F.lit(1)).alias("n_comments"))
    nk = chunks.groupBy(key).agg(F.count(F.lit(1)).alias("n_chunks"))
    return nk.join(nc, key, "inner").select(
        key, "n_chunks", "n_comments", (F.col("n_chunks") * F.col("n_comments")).alias("n_pairs")
    )


# ---------------------------------------------------------------------------
# TF-IDF variant (M5 option (b)): sparse term vectors, same blocked search.
# ---------------------------------------------------------------------------

TERM_PATTERN = r"[\p{L}\p{N}]+"


def term_counts(df: DataFrame, id_cols: list[str], text_col: str) -> DataFrame:
    """(ids..., term, tf) from lower-cased letter/digit runs."""
    return (
        df.select(*id_cols, F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(TERM_PATTERN), 0)).alias("term"))
        .groupBy(*id_cols, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def tfidf_nearest_chunk(comments: DataFrame, chunks: DataFrame, key: str = "video_id",
                        comment_key: str = "comment_pos", comment_text: str = "comment",
                        chunk_text: str = "chunk", block_size: int = DEFAULT_BLOCK,
                        rows_per_salt: int = DEFAULT_ROWS_PER_SALT,
                        comment_payload: list[str] | None = None,
                        chunk_payload: list[str] | None = None, group_size: int = GROUP_SIZE) -> DataFrame:
    """Nearest chunk by TF-IDF cosine within each video.

    ``idf(term) = ln((1 + n_chunks) / (1 + df))`` over the chunks of the
    video; weights are ``tf * idf``; comment vectors keep only terms that
    occur in the video's chunks. Ties (including all-zero rows) go to the
    lowest ``chunk_index``. Terms of every chunk have weight 0 and are left
    out, which also removes the most frequent keys. Payload columns are
    carried through the search as in ``nearest_chunk``.

    Videos of at most ``group_size`` (characters and ``ROW_SIZE`` for each row) and
    ``GROUP_PAIRS`` pairs meet in bounded groups of several videos; larger ones,
    and those whose rows are not told apart by their keys, go by joins.
    ``comments`` and ``chunks`` are read several times; pass them
    checkpointed when they are expensive.
    """
    carried = {"comment_payload": comment_payload or [], "chunk_payload": chunk_payload or []}
    names = key, comment_key, comment_text, chunk_text
    sizes = cut_lineage(_video_sizes(comments, chunks, *names), "sizes")
    small = (F.col("size") <= group_size) & (F.col("n_comments") * F.col("n_chunks") <= GROUP_PAIRS) & ~F.col("odd")
    total, large = sizes.agg(F.sum(F.when(small, F.col("size"))), F.count(F.when(~small, 1))).first()
    if not large:
        return _tfidf_in_groups(comments, chunks, *names, total or 0, **carried)
    apart = sizes.where(~small).select(key)
    left, right = ([df.join(apart, key, how) for df in (comments, chunks)] for how in ("left_anti", "left_semi"))
    found = _tfidf_by_joins(*right, *names, block_size, rows_per_salt, **carried)
    return _tfidf_in_groups(*left, *names, total or 0, **carried).unionByName(found)


def _video_sizes(comments: DataFrame, chunks: DataFrame, key: str, comment_key: str, comment_text: str, chunk_text: str) -> DataFrame:
    """(key, n_comments, n_chunks, size, odd): odd videos hold a row without a key of its own."""

    def side(df: DataFrame, own: str, text: str, is_chunk: int) -> DataFrame:
        rows = df.where(F.col(key).isNotNull()).groupBy(key, own).agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.length(text), F.lit(0))).alias("chars"))
        return rows.select(key, (F.col("n") * (1 - is_chunk)).alias("nc"), (F.col("n") * is_chunk).alias("nk"), (F.col("chars") + ROW_SIZE * F.col("n")).alias("size"),
                           (F.col(own).isNull() | (F.col("n") > 1)).alias("odd"))

    both = side(comments, comment_key, comment_text, 0).unionByName(side(chunks, "chunk_index", chunk_text, 1))
    return both.groupBy(key).agg(F.sum("nc").alias("n_comments"), F.sum("nk").alias("n_chunks"), F.sum("size").alias("size"), F.max("odd").alias("odd"))


def _tfidf_in_groups(comments: DataFrame, chunks: DataFrame, key: str, comment_key: str, comment_text: str, chunk_text: str, total: int,
                     comment_payload: list[str], chunk_payload: list[str]) -> DataFrame:
    """Videos dealt over groups of about ``BUNDLE_SIZE``; a group searches its videos at once."""
    groups = F.lit(max(1, math.ceil(total / BUNDLE_SIZE)))

    def dealt(df: DataFrame, text: str, *columns: str) -> DataFrame:
        terms = F.regexp_extract_all(F.lower(F.col(text)), F.lit(TERM_PATTERN), 0)
        return df.where(F.col(key).isNotNull()).select(*columns, terms.alias("_terms"), F.pmod(F.xxhash64(key), groups).alias("_deal"))

    a = dealt(comments, comment_text, key, comment_key, *comment_payload)
    b = dealt(chunks.withColumn("chunk_index", F.col("chunk_index").cast("int")), chunk_text, key, "chunk_index", *chunk_payload)
    schema = T.StructType([a.schema[c] for c in (key, comment_key, *comment_payload)])
    schema = schema.add("chunk_index", "integer").add("similarity", "double")
    for c in chunk_payload:
        schema = schema.add(b.schema[c])

    def found(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.take(pc.sort_indices(right["chunk_index"]))  # the first of equal ones has the lowest index
        video = pc.unique(right[key])
        left = left.filter(pc.is_in(left[key], video))
        of = [pc.index_in(t[key], video).to_numpy().astype(np.int64) for t in (left, right)]
        at, sim = _nearest_by_terms(*of, *(t["_terms"].combine_chunks() for t in (left, right)), len(video))
        own = right.take(pa.array(at))
        columns = {c: left[c] for c in (key, comment_key, *comment_payload)} | {"chunk_index": own["chunk_index"], "similarity": pa.array(sim)}
        return pa.table(columns | {c: own[c] for c in chunk_payload})

    return a.groupBy("_deal").cogroup(b.groupBy("_deal")).applyInArrow(found, schema)


def _tf(rows: pa.Array, terms: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, tf) in this order, of the terms' numbers in a column of lists."""
    sizes = pc.fill_null(pc.list_value_length(rows), 0).to_numpy()
    both, tf = np.unique(np.repeat(np.arange(len(sizes)), sizes) * count + terms, return_counts=True)
    return both // count, both % count, tf


def _nearest_by_terms(video_a: np.ndarray, video_b: np.ndarray, terms_a: pa.Array, terms_b: pa.Array, videos: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest chunk (the first of equal ones) of each comment and its similarity.
    ``video_a`` and ``video_b`` number the videos of the comments' and the chunks' rows; every video has a chunk."""
    n_a, n_b = len(video_a), len(video_b)
    # what shares no term has the first chunk
    at, best = np.full(videos, n_b), np.zeros(n_a)
    np.minimum.at(at, video_b, np.arange(n_b))
    at = at[video_a]
    flat = [t.flatten() for t in (terms_a, terms_b)]
    encoded = pa.concat_arrays(flat).dictionary_encode()
    count, numbers = max(1, len(encoded.dictionary)), encoded.indices.to_numpy().astype(np.int64)
    row_b, term_b, tf_b = _tf(terms_b, numbers[len(flat[0]) :], count)
    known, place, df = np.unique(video_b[row_b] * count + term_b, return_inverse=True, return_counts=True)
    n_chunks = np.bincount(video_b, minlength=videos)[known // count]
    idf = np.where(df < n_chunks, np.log((1 + n_chunks) / (1 + df)), 0.0)
    weight_b = tf_b * idf[place]
    norm_b = np.sqrt(np.bincount(row_b, weight_b * weight_b, minlength=n_b))
    # a known term's chunks and their weights, side by side
    order = np.argsort(place, kind="stable")
    posted, posted_weight, first = row_b[order], weight_b[order], np.cumsum(df) - df

    row_a, term_a, tf_a = _tf(terms_a, numbers[: len(flat[0])], count)
    asked = video_a[row_a] * count + term_a
    place = np.searchsorted(known, asked)
    met = place < len(known)
    met[met] = known[place[met]] == asked[met]
    met[met] = idf[place[met]] > 0
    row_a, place, weight_a = row_a[met], place[met], (tf_a[met] * idf[place[met]])
    norm_a = np.sqrt(np.bincount(row_a, weight_a * weight_a, minlength=n_a))
    # whole comments, and about MET term places of chunks at a time
    ends = np.flatnonzero(np.diff(row_a, append=n_a)) + 1
    done = np.cumsum(df[place])[ends - 1] if len(ends) else ends
    start = k = 0
    while k < len(ends):
        k = max(k + 1, int(np.searchsorted(done, (done[k - 1] if k else 0) + MET, "right")))
        part, start = slice(start, ends[k - 1]), ends[k - 1]
        n = df[place[part]]
        to = np.repeat(first[place[part]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        pair = np.repeat(row_a[part], n) * n_b + posted[to]
        x = np.repeat(weight_a[part], n) * posted_weight[to]
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        begin = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
        a, b = pair[begin] // n_b, pair[begin] % n_b
        sim = np.add.reduceat(x[order], begin) / (norm_a[a] * norm_b[b])
        rank = _ranks(sim)
        order = np.lexsort((-b, rank, a))
        last = order[np.flatnonzero(np.diff(a[order], append=n_a))]
        # a rank of zero is that of chunks without a common term, too
        last = last[(rank[last] > 0) | (b[last] == at[a[last]])]
        at[a[last]], best[a[last]] = b[last], sim[last]
    return at, best


def _tfidf_by_joins(comments: DataFrame, chunks: DataFrame, key: str, comment_key: str, comment_text: str, chunk_text: str,
                    block_size: int, rows_per_salt: int, comment_payload: list[str], chunk_payload: list[str]) -> DataFrame:
    """Videos of any size. The chunks' term counts and the idf table are written once in
    the shared checkpoint folder (``session.cut_lineage``)."""
    ktf = cut_lineage(term_counts(chunks, [key, "chunk_index"], chunk_text), "terms")
    nchunks = chunks.groupBy(key).agg(F.count(F.lit(1)).alias("_nk"))
    idf = cut_lineage(
        ktf.groupBy(key, "term").agg(F.count(F.lit(1)).alias("_df"))
        .join(nchunks, key)
        .where(F.col("_df") < F.col("_nk"))
        .select(key, "term", F.log((1 + F.col("_nk")) / (1 + F.col("_df"))).alias("idf")),
        "idf",
    )
    weight = (F.col("tf") * F.col("idf")).alias("w")
    kvec = (
        ktf.join(idf, [key, "term"])
        .select(key, "chunk_index", "term", weight)
        .groupBy(key, "chunk_index")
        .agg(
            F.map_from_entries(F.collect_list(F.struct("term", "w"))).alias("terms"),
            F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"),
        )
    )
    cvec = (
        term_counts(comments, [key, comment_key], comment_text)
        .join(idf, [key, "term"])
        .select(key, comment_key, "term", weight)
        .groupBy(key, comment_key)
        .agg(
            F.collect_list(F.struct("term", "w")).alias("_terms"),
            F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_n"),
        )
    )
    # texts sharing no term with the others still take part, with similarity 0
    call = comments.select(key, comment_key, *comment_payload).join(cvec, [key, comment_key], "left")
    elem = F.struct(F.col("chunk_index").cast("int").alias("chunk_index"),
                    F.coalesce("terms", F.create_map().cast("map<string,double>")).alias("terms"),
                    F.coalesce("norm", F.lit(0.0)).alias("norm"), *[F.col(p) for p in chunk_payload])
    blocks = (
        chunks.select(key, "chunk_index", *chunk_payload).join(kvec, [key, "chunk_index"], "left")
        .select(key, F.floor((F.col("chunk_index") - 1) / block_size).alias("block"), elem.alias("c"))
        .groupBy(key, "block")
        .agg(F.collect_list("c").alias("cs"))
    )
    joined = _salted(call, blocks, key, comment_key, rows_per_salt)

    d = ("aggregate(coalesce(_terms, CAST(array() AS array<struct<term:string,w:double>>)), 0D, "
         "(acc_, e_) -> acc_ + e_.w * coalesce(try_element_at(c_.terms, e_.term), 0D))")
    den = "(coalesce(_n, 0D) * c_.norm)"
    sims = f"transform(cs, c_ -> CASE WHEN {den} > 0 THEN {d} / {den} ELSE 0D END)"
    return _best_match(joined, key, comment_key, sims, comment_payload, chunk_payload)
