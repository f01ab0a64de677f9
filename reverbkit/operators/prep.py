"""Labelled-data preparation.

Rows are ordered inside each label by a seeded hash ``md5(seed || key)``
(deterministic, identical in any engine), ties by key.

Scale: there are only a handful of labels, so a plain
``row_number() over (partition by label ...)`` would put a sixth of all rows
into one task. ``rank_within_label`` computes the *exact same* rank in two
levels instead:

1. histogram of rows per (label, hash-prefix bucket) - a partial aggregate
   whose size is bounded by labels x buckets, not by the data;
2. running totals over the buckets of each label (window over that small
   table) give the number of rows before each bucket;
3. ``row_number()`` inside (label, bucket) - thousands of small, evenly
   filled window partitions - plus the bucket offset is the global rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reverbkit.constants import EMOTIONS, SEED, SPLIT_TRAIN, SPLIT_VAL

BUCKET_HEX = 4  # 16^4 = 65 536 buckets per label


def seeded_hash(key: Column, seed: str | int = SEED) -> Column:
    return F.md5(F.concat(F.lit(str(seed)), key.cast("string")))


def rank_within_label(df: DataFrame, label: str, key: str, seed: str | int = SEED,
                      bucket_hex: int = BUCKET_HEX, limit: Column | None = None) -> DataFrame:
    """Adds ``rank`` (1-based, by (hash, key) within ``label``) and ``n_label``.
    Null labels are a label of their own. With ``limit`` the buckets that start
    beyond it are dropped before the rest is ranked.

    ``key`` must identify a row (a document id, not its text): buckets come
    from the hash of the key, so many rows sharing one key value would share
    one bucket."""
    h = df.withColumn("_h", seeded_hash(F.col(key), seed)).withColumn(
        "_b", F.conv(F.substring("_h", 1, bucket_hex), 16, 10).cast("int")
    )
    hist = h.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    w_run = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_all = Window.partitionBy(label)
    offsets = hist.select(
        label, "_b",
        (F.sum("_cnt").over(w_run) - F.col("_cnt")).alias("_before"),
        F.sum("_cnt").over(w_all).alias("n_label"),
    )
    w_in = Window.partitionBy(label, "_b").orderBy("_h", key)
    offsets = offsets.select(F.col(label).alias("_label"), F.col("_b").alias("_bucket"), "_before", "n_label")
    if limit is not None:
        offsets = offsets.where(F.col("_before") < limit)
    kept = h.join(offsets, F.col(label).eqNullSafe(F.col("_label")) & (F.col("_b") == F.col("_bucket")))
    return (
        kept.drop("_label", "_bucket")
        .withColumn("_r", F.row_number().over(w_in))
        .withColumn("rank", (F.col("_before") + F.col("_r")).cast("long"))
        .drop("_h", "_b", "_r", "_before")
    )


def undersample(df: DataFrame, label: str, key: str, n: int | None = None,
                seed: str | int = SEED) -> DataFrame:
    """M1: exactly ``n`` rows per label (default: the smallest label's count).

    Rows without a label take no part. Raises at run time (``raise_error``) if a label has fewer than ``n`` rows,
    like the reference's sampler.
    """
    df = df.where(F.col(label).isNotNull())
    if n is None:
        # smallest class size: a partial aggregate over the input, one value
        limit = df.groupBy(label).agg(F.count(F.lit(1)).alias("c")).agg(F.min("c")).scalar()
    else:
        limit = F.lit(int(n))
    r = rank_within_label(df, label, key, seed, limit=limit)
    if n is not None:
        r = r.withColumn(
            "n_label",
            F.when(F.col("n_label") < limit, F.raise_error(F.lit(f"a label has fewer than {n} rows"))).otherwise(
                F.col("n_label")
            ),
        )
    return r.where(F.col("rank") <= limit).drop("n_label")


def stratified_split(df: DataFrame, label: str, key: str, seed: str | int = SEED,
                     train: float = SPLIT_TRAIN, val: float = SPLIT_VAL) -> DataFrame:
    """M2: 70 / 15 / 15 per label, exact by rank: rank <= floor(.70 n) is
    train, rank <= floor(.85 n) is validation, the rest test (integer
    percent arithmetic, so no float rounding decides a boundary)."""
    r = rank_within_label(df, label, key, f"split{seed}")
    n = F.col("n_label")
    tr, tv = int(round(train * 100)), int(round((train + val) * 100))
    return r.withColumn(
        "split",
        F.when(F.col("rank") <= F.expr(f"(n_label * {tr}) div 100"), F.lit("train"))
        .when(F.col("rank") <= F.expr(f"(n_label * {tv}) div 100"), F.lit("val"))
        .otherwise(F.lit("test")),
    ).drop("n_label", "rank")


def hash_split(df: DataFrame, key: str, seed: str | int = SEED,
               train: float = SPLIT_TRAIN, val: float = SPLIT_VAL) -> DataFrame:
    """M2, scale mode: no shuffle at all. Each row falls in a seeded hash
    bucket 0..99; buckets below 70 are train, below 85 validation, the rest
    test. Proportions hold in expectation per label (the hash ignores the
    label), not exactly; use ``stratified_split`` for exact per-label sizes."""
    b = F.pmod(F.xxhash64(F.lit(str(seed)), F.col(key)), F.lit(100))
    tr, tv = int(round(train * 100)), int(round((train + val) * 100))
    return df.withColumn(
        "split", F.when(b < tr, F.lit("train")).when(b < tv, F.lit("val")).otherwise(F.lit("test"))
    )


def label_name(label: Column) -> Column:
    """Class index -> emotion name (null outside 0..5)."""
    names = F.array(*[F.lit(e) for e in EMOTIONS])
    return F.when(label.between(0, len(EMOTIONS) - 1), F.element_at(names, (label + 1).cast("int")))


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """A3 + A6 + P7: rows per label, its name, and the number of distinct labels."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    n_labels = counts.agg(F.count(F.lit(1))).scalar()
    return counts.select(label, label_name(F.col(label)).alias("emotion"), "n", n_labels.alias("n_labels"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights ``N / (K * n_label)``."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    tot = counts.agg(F.sum("n").cast("double").alias("N"), F.count(F.lit(1)).cast("double").alias("K"))
    n_all = tot.select("N").scalar()
    k_all = tot.select("K").scalar()
    return counts.select(label, "n", (n_all / (k_all * F.col("n"))).alias("weight"))
