"""Classifier training over epochs and mini-batches (M6, M7), kept as tables.

The reference trains its classification head with AdamW for a few epochs,
validates after each, and tests the result once. Here a step is one Spark job:

* training rows are written once, partitioned by mini-batch (a keyed hash), so
  a step reads its own batch only; the order of the batches changes per epoch;
* each task sums the gradient of its rows with numpy over sparse features,
  and the sums meet in a tree: tasks -> ``FAN`` groups -> the step. What reaches
  the driver is the size of the model (``classes x (dims + 1)``), whatever the
  data; longer gradients travel in chunks of ``CHUNK`` numbers;
* after an epoch the validation rows are scored with the weights so far: one
  aggregate of at most classes x classes cells. The epoch with the lowest
  validation loss gives the model, and the test rows are read once, for it.

Features are (index, value) arrays: ``vector_features`` of dense vectors,
``text_features`` of hashed terms. Every number is a function of the rows and the seed,
not of the partitioning (but for the last bits of floating-point sums).

Rows with a null label or a label outside 0..classes - 1 take no part. A split
without rows gives null metrics (no validation rows: the first epoch is taken). A row without features is scored by the bias.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reverbkit.constants import SEED
from reverbkit.session import checkpoint_dir, cut_lineage

FAN = 8
CHUNK = 1 << 16
VAL, TEST = -1, -2  # beside the batches' numbers
FEATURES = "struct<idx:array<int>,val:array<double>>"
TERM_PATTERN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x00-\x20]+"  # words, and runs of marks
CAPS = "<caps>"  # beside a word in capitals


@dataclass(frozen=True)
class Settings:
    epochs: int = 5
    batches: int = 8  # mini-batches an epoch
    rate: float = 0.05
    decay: float = 0.01
    beta1: float = 0.9
    beta2: float = 0.999
    eps: float = 1e-8
    seed: int = SEED


@dataclass
class SoftmaxModel:
    """Weights of a linear softmax classifier, the bias in the last column."""

    weights: np.ndarray
    history: list[dict] = field(default_factory=list)

    def probabilities(self, b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The rows' class probabilities, and their features row by row."""
        f = b["features"]
        idx, val = f.field("idx"), f.field("val")
        row = np.repeat(np.arange(b.num_rows), np.diff(idx.offsets.to_numpy()))
        i, v = idx.flatten().to_numpy(), val.flatten().to_numpy()
        z = np.stack([np.bincount(row, v * w[i], minlength=b.num_rows) + w[-1] for w in self.weights], axis=1)
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True), row, i, v


def vector_features(vec: str = "vec") -> F.Column:
    """Features of a dense array<double> column."""
    empty = "cast(array() as array<int>)"
    return F.expr(f"named_struct('idx', if(size({vec}) > 0, sequence(0, size({vec}) - 1), {empty}), 'val', {vec})").cast(FEATURES)


def hashed_terms(df: DataFrame, key: str, text_col: str, dims: int) -> DataFrame:
    """(key, idx, tf): lower-cased terms, hashed to ``dims`` places (dims <= 2^24)."""
    terms = df.select(key, F.explode(F.regexp_extract_all(F.col(text_col), F.lit(TERM_PATTERN), 0)).alias("t"))
    both = F.when(F.col("t").rlike(r"^\p{Lu}{2,}$"), F.array(F.lower("t"), F.lit(CAPS))).otherwise(F.array(F.lower("t")))
    term = terms.select(key, F.explode(both).alias("t"))
    place = F.conv(F.substring(F.md5("t"), 1, 6), 16, 10).cast("int") % dims
    return term.groupBy(key, place.alias("idx")).agg(F.count(F.lit(1)).alias("tf"))


def text_features(df: DataFrame, key: str, text_col: str, dims: int, fitted_on: DataFrame | None = None) -> DataFrame:
    """``df`` with ``features``: (1 + ln tf) * idf of hashed terms, of unit length.
    The idf table has one row for each place, a bound that ``dims`` sets, and comes from the rows of ``df`` that
    ``fitted_on`` holds (by ``key``; default: all). ``key`` identifies a row."""
    terms = cut_lineage(hashed_terms(df, key, text_col, dims), "hashed-terms")
    fitted = terms if fitted_on is None else terms.join(fitted_on.select(key), key, "left_semi")
    count = (df if fitted_on is None else fitted_on).agg(F.count(F.lit(1))).scalar()
    idf = fitted.groupBy("idx").agg((F.log((1 + count) / (1 + F.count(F.lit(1)))) + 1).alias("idf"))
    # a place that no fitted row has counts like df = 0
    unseen = F.log(1.0 + count) + 1
    weighed = terms.join(F.broadcast(idf), "idx", "left").select(key, "idx", ((1 + F.log("tf")) * F.coalesce("idf", unseen)).alias("w"))
    rows = weighed.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("idx", "w"))).alias("f"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    features = F.expr(f"cast(named_struct('idx', transform(f, x -> x.idx), 'val', transform(f, x -> x.w / norm)) as {FEATURES})")
    none = F.expr(f"cast(named_struct('idx', array(), 'val', array()) as {FEATURES})")
    return df.join(rows.select(key, features.alias("features")), key, "left").withColumn("features", F.coalesce("features", none))


def _task_sums(model: SoftmaxModel) -> Callable:
    """The gradient, loss and weight of a task's rows, in chunks."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, width = model.weights.shape
        grad, loss, weight = np.zeros((classes, width)), 0.0, 0.0
        for b in batches:
            p, row, i, v = model.probabilities(b)
            y, w, at = b["label"].to_numpy(), b["weight"].to_numpy(), np.arange(b.num_rows)
            loss += float(-(np.log(np.clip(p[at, y], 1e-15, 1)) * w).sum())
            weight += float(w.sum())
            p[at, y] -= 1
            p *= w[:, None]
            for k in range(classes):
                grad[k] += np.bincount(i, v * p[row, k], minlength=width)
                grad[k, -1] += p[:, k].sum()
        flat = np.concatenate((grad.ravel(), [loss, weight]))
        parts = [flat[at : at + CHUNK] for at in range(0, len(flat), CHUNK)]
        slot = TaskContext.get().partitionId() % FAN
        yield pa.RecordBatch.from_arrays(
            [pa.array([slot] * len(parts), pa.int32()), pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.list_(pa.float64()))], ["slot", "chunk", "sums"]
        )

    return sums


def _add(table: pa.Table) -> pa.Table:
    """One chunk of one group of tasks."""
    total = 0.0
    for x in table["sums"]:
        total = total + x.values.to_numpy()
    return pa.table({"slot": table["slot"][:1], "chunk": table["chunk"][:1], "sums": pa.array([total], pa.list_(pa.float64()))})


def _gradient(rows: DataFrame, model: SoftmaxModel) -> tuple[np.ndarray, float, float]:
    """Gradient, summed loss and summed weight over all ``rows``."""
    schema = "slot int, chunk int, sums array<double>"
    met = rows.mapInArrow(_task_sums(model), schema).groupBy("slot", "chunk").applyInArrow(_add, schema).toArrow()
    classes, width = model.weights.shape
    flat = np.zeros(classes * width + 2)
    for chunk, x in zip(met["chunk"].to_pylist(), met["sums"], strict=True):
        part = x.values.to_numpy()
        flat[chunk * CHUNK : chunk * CHUNK + len(part)] += part
    return flat[:-2].reshape(classes, width), float(flat[-2]), float(flat[-1])


def predict(rows: DataFrame, model: SoftmaxModel, keep: list[str]) -> DataFrame:
    """``keep`` columns of (.., label, features) rows with probs, pred (the first of
    the likeliest) and the row's loss."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = model.probabilities(b)[0]
            y = b["label"].fill_null(0).to_numpy()
            loss = -np.log(np.clip(p[np.arange(b.num_rows), y], 1e-15, 1))
            yield pa.RecordBatch.from_arrays(
                [*[b[c] for c in keep], pa.array(list(p), pa.list_(pa.float64())), pa.array(p.argmax(axis=1), pa.int32()), pa.array(loss)], [*keep, "probs", "pred", "loss"]
            )

    asked = rows.select(*dict.fromkeys([*keep, "label", "features"]))
    schema = asked.select(*keep).schema
    schema = schema.add("probs", T.ArrayType(T.DoubleType())).add("pred", "integer").add("loss", "double")
    return asked.mapInArrow(scored, schema)


def evaluate(predictions: DataFrame) -> dict:
    """n, loss, accuracy, weighted precision / recall / F1 and the share of the most
    frequent class of scored rows (label, pred, loss). One aggregate; the classes x
    classes cells that it leaves are summed up here."""
    cells = predictions.groupBy("label", "pred").agg(F.count(F.lit(1)).alias("n"), F.sum("loss").alias("loss")).collect()
    n = sum(c["n"] for c in cells)
    if not n:
        return dict.fromkeys(("loss", "accuracy", "precision", "recall", "f1", "majority")) | {"n": 0}
    support, predicted, right = Counter(), Counter(), Counter()
    for c in cells:
        support[c["label"]] += c["n"]
        predicted[c["pred"]] += c["n"]
        right[c["label"]] += c["n"] * (c["label"] == c["pred"])
    precision = {k: right[k] / predicted[k] if predicted[k] else 0.0 for k in support}
    recall = {k: right[k] / support[k] for k in support}
    f1 = {k: 2 * precision[k] * recall[k] / (precision[k] + recall[k]) if precision[k] + recall[k] else 0.0 for k in support}
    weighed = {name: sum(support[k] * x[k] for k in support) / n for name, x in (("precision", precision), ("recall", recall), ("f1", f1))}
    return {"n": n, "loss": math.fsum(c["loss"] for c in cells) / n, "accuracy": sum(right.values()) / n, "majority": max(support.values()) / n, **weighed}


def _batch(key: str, s: Settings) -> F.Column:
    hashed = F.md5(F.concat(F.lit(f"batch{s.seed}"), F.col(key).cast("string")))
    return F.conv(F.substring(hashed, 1, 8), 16, 10).cast("long") % s.batches


def train(rows: DataFrame, key: str, classes: int, dims: int, s: Settings | None = None, weights: DataFrame | None = None) -> tuple[SoftmaxModel, DataFrame]:
    """Trains on the ``train`` rows of (key, label, split, features), choosing among the epochs by the
    ``val`` rows. Returns the model, whose ``history`` has a dict for each epoch and
    one for the ``test`` split, and the test rows' predictions, written once.
    ``weights`` (label, weight) weighs the classes in the training loss."""
    s = s or Settings()
    spark = rows.sparkSession
    asked = rows.where(F.col("label").between(0, classes - 1)).select(key, F.col("label").cast("int").alias("label"), "split", "features")
    weight = F.lit(1.0)
    if weights is not None:  # one row per class
        asked = asked.join(F.broadcast(weights.select(F.col("label").cast("int").alias("label"), F.col("weight").cast("double").alias("weight"))), "label", "left")
        weight = F.coalesce("weight", F.lit(1.0))
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/batches-{uuid.uuid4().hex}"
    part = F.when(F.col("split") == "train", _batch(key, s)).otherwise(F.when(F.col("split") == "val", VAL).otherwise(TEST))
    # a batch's rows are dealt over several files by hash, so that no task writes a whole batch
    placed = asked.select(key, "label", weight.alias("weight"), "features", part.alias("part"), F.pmod(F.xxhash64(key), F.lit(32)).alias("deal"))
    placed.repartition("part", "deal").drop("deal").write.partitionBy("part").parquet(path)
    stored = spark.read.schema(placed.drop("deal").schema).parquet(path)

    model = SoftmaxModel(np.zeros((classes, dims + 1)))
    m, v = np.zeros_like(model.weights), np.zeros_like(model.weights)
    best, step = None, 0
    for epoch in range(1, s.epochs + 1):
        losses = []
        for batch in sorted(range(s.batches), key=lambda b: hashlib.md5(f"{s.seed}-{epoch}-{b}".encode()).hexdigest()):
            grad, loss, total = _gradient(stored.where(F.col("part") == batch), model)
            step += 1
            if total > 0:
                grad, _ = grad / total, losses.append(loss / total)
            m, v = s.beta1 * m + (1 - s.beta1) * grad, s.beta2 * v + (1 - s.beta2) * grad * grad
            stride = (m / (1 - s.beta1**step)) / (np.sqrt(v / (1 - s.beta2**step)) + s.eps)
            model = SoftmaxModel(model.weights - s.rate * (stride + s.decay * model.weights), model.history)
        told = evaluate(predict(stored.where(F.col("part") == VAL), model, ["label"]))
        model.history.append({"split": "val", "epoch": epoch, "train_loss": sum(losses) / len(losses) if losses else None, **told})
        if best is None or (told["n"] and told["loss"] < best[0]):
            best = (told["loss"], epoch, model.weights)
    model = SoftmaxModel(best[2], model.history)
    predictions = cut_lineage(predict(stored.where(F.col("part") == TEST), model, [key, "label"]), "predictions")
    model.history.append({"split": "test", "epoch": best[1], "train_loss": None, **evaluate(predictions)})
    return model, predictions


def history(model: SoftmaxModel, spark: SparkSession) -> DataFrame:
    """The model's history as a table: a row per epoch and one for the test split."""
    schema = "split string, epoch int, train_loss double, loss double, accuracy double, precision double, recall double, f1 double, majority double, n long"
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(h[c] for c in names) for h in model.history], schema)


def save(model: SoftmaxModel, spark: SparkSession, path: str) -> None:
    """The weights as a table, a row per class; the history beside it."""
    rows = [(k, w.tolist()) for k, w in enumerate(model.weights)]
    spark.createDataFrame(rows, "label int, weights array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/weights")
    history(model, spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/history")


def load(spark: SparkSession, path: str) -> SoftmaxModel:
    rows = spark.read.parquet(f"{path}/weights").orderBy("label").collect()
    told = [r.asDict() for r in spark.read.parquet(f"{path}/history").collect()]
    told.sort(key=lambda h: (h["split"] == "test", h["epoch"]))
    return SoftmaxModel(np.array([r["weights"] for r in rows]), told)
