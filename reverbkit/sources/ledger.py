"""A sink that reruns only what changed.

The outputs of an analysis lie under one root, each dealt over the same number of
buckets by a hash of the video. A ledger beside them holds the fingerprint
of each finished video's input. A rerun analyses the videos whose fingerprint is
new, and rewrites only the buckets these lie in, by dynamic partition overwrite; the
ledger comes last, so a run that is lost half way is done again for the same
videos and writes the same rows in place of what it had written.

The number of buckets is kept with the ledger: it is chosen once, so that a bucket
of the largest output suits a few tasks. Rows of a bucket are dealt over files by
their size (``rebalance``), so a video of any size does not meet one task.

Defined results: a null video is a video like any other; rows of ``videos``
that share an id are one video, its fingerprint covering all of them; nothing to
rerun writes nothing; an output without rows for a video deletes those of before.
A video that is no longer among ``videos`` keeps its outputs until ``forget``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from reverbkit.session import cut_lineage

BUCKETS = 256
BUCKET = "_bucket"
LEDGER, LAYOUT, COLUMNS = "_ledger", "_layout", "_columns"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def _existing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The rows of an output, or None where nothing has been written."""
    try:
        return spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def replace_rows(rows: DataFrame, path: str, done: DataFrame, key: str, buckets: int) -> None:
    """Puts ``rows`` in place of all rows at ``path`` whose ``key`` is in ``done``.
    Only buckets of ``done`` are read and written; what they will hold is written to
    the shared checkpoint folder first, as a folder can't be read while it is replaced."""
    spark = rows.sparkSession
    new = rows.withColumn(BUCKET, bucket_of(key, buckets))
    old = _existing(spark, path, rows.schema)
    touched: list[int] = []
    if old is not None:
        # at most one value per bucket
        touched = [r[0] for r in done.select(bucket_of(key, buckets)).distinct().collect()]
        gone = done.select(F.col(key).alias("_done")).distinct()
        kept = old.where(F.col(BUCKET).isin(touched)).join(gone, F.col(key).eqNullSafe(F.col("_done")), "left_anti")
        new = new.unionByName(kept)
    staged = cut_lineage(new, "staged")
    (staged.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path))
    if old is not None:
        # a dynamic overwrite leaves a bucket alone that has no rows any more
        full = {r[0] for r in staged.select(BUCKET).distinct().collect()}
        _empty(spark, path, rows.schema, [b for b in touched if b not in full])


def _empty(spark: SparkSession, path: str, schema: T.StructType, buckets: list[int]) -> None:
    """Deletes the files of some buckets, through the file system of the path."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for b in buckets:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{BUCKET}={b}")
        folder.getFileSystem(conf).delete(folder, True)


def fingerprints(videos: DataFrame, key: str) -> DataFrame:
    """(key, fingerprint): two hashes over all columns of all rows of a video, whatever
    their order."""
    cols = sorted(c for c in videos.columns if c != key)
    # as JSON, so that nulls, empty values and neighbours stay apart
    row = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}) if cols else F.lit("")
    h = videos.select(key, F.sha2(row, 256).alias("h"))
    n = h.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.conv(F.substring("h", 1 + 12 * i, 12), 16, 10).cast("decimal(20,0)")).alias(f"h{i}") for i in range(4)])
    return n.select(key, F.concat_ws(":", "n", "h0", "h1", "h2", "h3").alias("fingerprint"))


def finished(spark: SparkSession, root: str, key: T.StructField) -> DataFrame | None:
    return _existing(spark, f"{root.rstrip('/')}/{LEDGER}", T.StructType([key, T.StructField("fingerprint", T.StringType())]))


def _buckets(spark: SparkSession, root: str, asked: int) -> int:
    path = f"{root.rstrip('/')}/{LAYOUT}"
    layout = T.StructType([T.StructField("buckets", T.IntegerType())])
    try:
        return spark.read.schema(layout).parquet(path).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    spark.createDataFrame([(asked,)], layout).write.parquet(path)
    return asked


def rerun(videos: DataFrame, root: str, analyse: Callable[[DataFrame], dict[str, DataFrame]], key: str = "video_id", buckets: int = BUCKETS) -> DataFrame:
    """Analyses the videos that are new or changed since the last run under ``root``
    and replaces their rows in each output of ``analyse``, which must hold the
    column ``key``. ``buckets`` counts in the first run. Returns the ids done."""
    spark, root = videos.sparkSession, root.rstrip("/")
    buckets = _buckets(spark, root, buckets)
    now = fingerprints(videos, key)
    before = finished(spark, root, videos.schema[key])
    if before is not None:
        same = before.select(F.col(key).alias("_id"), F.col("fingerprint").alias("_f"))
        now = now.join(same, F.col(key).eqNullSafe(F.col("_id")) & (F.col("fingerprint") == F.col("_f")), "left_anti")
    now = cut_lineage(now, "pending")
    done = now.select(key)
    if now.isEmpty():
        return done
    ids = done.select(F.col(key).alias("_id"))
    todo = videos.join(ids, F.col(key).eqNullSafe(F.col("_id")), "left_semi")
    for name, rows in analyse(todo).items():
        _keep_columns(rows, root, name)
        replace_rows(rows, f"{root}/{name}", done, key, buckets)
    _keep_columns(now, root, LEDGER)
    replace_rows(now, f"{root}/{LEDGER}", done, key, buckets)
    return done


def _keep_columns(rows: DataFrame, root: str, name: str) -> None:
    """An output without rows has no file that tells its columns."""
    rows.sparkSession.createDataFrame([], rows.schema).write.mode("overwrite").parquet(f"{root}/{COLUMNS}/{name}")


def read_output(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The rows of an output of ``rerun``, those of all runs."""
    schema = spark.read.parquet(f"{root.rstrip('/')}/{COLUMNS}/{name}").schema
    return _existing(spark, f"{root.rstrip('/')}/{name}", schema).drop(BUCKET)


def forget(spark: SparkSession, root: str, names: list[str], done: DataFrame, key: str = "video_id") -> None:
    """Deletes the rows of some videos from the named outputs and the ledger."""
    root = root.rstrip("/")
    buckets = _buckets(spark, root, BUCKETS)
    for name in [*names, LEDGER]:
        replace_rows(spark.createDataFrame([], read_output(spark, root, name).schema), f"{root}/{name}", done, key, buckets)
