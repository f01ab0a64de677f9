"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reverbkit.session import cut_lineage

__all__ = ["block_groups", "cut_lineage", "finite", "give_back", "learn_fold", "matrix", "read", "slices", "texts"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator works on, under fixed names: whatever else
    ``docs`` holds can neither clash with the operator's columns nor be read.
    A null text counts as the empty one."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def slices(b: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """A batch in small parts, so that Python objects are made for few rows at a
    time; what Arrow keeps of the batch's memory goes back afterwards."""
    for at in range(0, b.num_rows, rows):
        yield b.slice(at, rows)
    give_back()


def give_back() -> None:
    """Hands memory that Arrow and the allocator keep for later back to the system:
    Python workers live on between the stages of a job."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def learn_fold(id_col: str, modulus: int) -> Column:
    """The fold of a row: crc32 of its id as text, modulo ``modulus``."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus, F.lit(0))


def block_groups(left: DataFrame, right: DataFrame, key: str, row_id: str, block: int, match: Callable, schema: str, right_block: int | None = None) -> DataFrame:
    """Meets all rows of ``left`` and ``right`` that share ``key``, in groups of
    at most about ``2 * block`` rows (``block + right_block``) whatever the size of
    a key.

    Both frames have the same columns. A key with more than ``block`` rows on a
    side is salted: its rows are dealt over ceil(rows / block) blocks by a hash
    of ``row_id``, and every block of one side meets every block of the other
    side in a group of its own. ``match(table)`` gets one group (an Arrow table), with the column
    ``_left`` telling the side, and returns rows of ``schema``."""

    def sizes(df: DataFrame, name: str, block: int) -> DataFrame:
        return df.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias(name))

    n = sizes(left, "_na", block).join(sizes(right, "_nb", right_block or block), key)

    def dealt(df: DataFrame, own: str, n_own: str, other: str, n_other: str, is_left: bool) -> DataFrame:
        salted = df.join(n, key).withColumn(own, F.pmod(F.xxhash64(row_id), F.col(n_own)).cast("int"))
        return salted.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(n_other) - 1))).select(
            *df.columns, "_a", "_b", F.lit(is_left).alias("_left")
        )

    both = dealt(left, "_a", "_na", "_b", "_nb", True).unionByName(dealt(right, "_b", "_nb", "_a", "_na", False))
    # by a number of partitions, as AQE would put a few small but costly groups into one task
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return both.repartition(parts, key, "_a", "_b").groupBy(key, "_a", "_b").applyInArrow(match, schema)


def finite(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vec, ok): a vector takes part if it is not null, not empty, not
    zero and holds neither nulls nor non-finite numbers."""
    v = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vec"))
    ok = F.expr("vec is not null and size(vec) > 0 and forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('inf')) and exists(vec, x -> x != 0)")
    return v.withColumn("ok", F.coalesce(ok, F.lit(False)))


def matrix(column: pa.ChunkedArray | pa.Array, width: int | None = None) -> np.ndarray:
    """The arrays of a column as rows of doubles, filled up with zeros."""
    lists = column.to_numpy(zero_copy_only=False)
    width = width or max(map(len, lists), default=0)
    if all(len(x) == width for x in lists):
        return np.array(lists.tolist(), np.float64).reshape(len(lists), width)
    out = np.zeros((len(lists), width))
    for row, x in zip(out, lists, strict=True):
        row[: min(width, len(x))] = x[:width]
    return out
