"""Classifier evaluation.

Only the confusion counts (A9) touch the data - one partial aggregate keyed
by (label, prediction), at most K x K rows. Accuracy, per-class precision /
recall / F1 with ``zero_division = 0``, the macro and support-weighted
averages are computed from that K x K table, so they cost nothing at scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reverbkit.constants import EMOTIONS


def confusion_counts(pred: DataFrame, label: str = "label", prediction: str = "pred") -> DataFrame:
    """(label, pred) -> n."""
    return pred.groupBy(F.col(label).alias("label"), F.col(prediction).alias("pred")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _z(num, den):
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def per_class(confusion: DataFrame) -> DataFrame:
    """class, tp, support, predicted, precision, recall, f1 for every class
    seen as a label or as a prediction.

    One aggregate: each (label, pred, n) cell contributes its count to the
    label's support (and tp on the diagonal) and to the prediction's column
    total, so the confusion table is read once (no self-join)."""
    contrib = confusion.select(
        F.explode(
            F.array(
                F.struct(F.col("label").alias("cls"), F.col("n").alias("support"),
                         F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(F.lit(0)).alias("tp"),
                         F.lit(0).cast("long").alias("predicted")),
                F.struct(F.col("pred").alias("cls"), F.lit(0).cast("long").alias("support"),
                         F.lit(0).cast("long").alias("tp"), F.col("n").alias("predicted")),
            )
        ).alias("c")
    ).select("c.*")
    c = contrib.groupBy("cls").agg(
        F.sum("tp").cast("long").alias("tp"),
        F.sum("support").cast("long").alias("support"),
        F.sum("predicted").cast("long").alias("predicted"),
    )
    p = _z(F.col("tp").cast("double"), F.col("predicted"))
    r = _z(F.col("tp").cast("double"), F.col("support"))
    c = c.withColumn("precision", p).withColumn("recall", r)
    return c.withColumn(
        "f1", _z(2.0 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    )


def weighted_metrics(confusion: DataFrame) -> DataFrame:
    """A10 + A11: one row - n, accuracy, weighted precision / recall / F1."""
    pc = per_class(confusion)
    return pc.agg(
        F.sum("support").alias("n"),
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        (F.sum(F.col("support") * F.col("precision")) / F.sum("support")).alias("precision"),
        (F.sum(F.col("support") * F.col("recall")) / F.sum("support")).alias("recall"),
        (F.sum(F.col("support") * F.col("f1")) / F.sum("support")).alias("f1"),
    )


def class_report(confusion: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Per-class rows plus 'macro avg' and 'weighted avg'.

    The per-class table (one row per class, a bound set by the label domain)
    is read once: a window over it yields the averages, and the first class
    row also emits the two summary rows."""
    from pyspark.sql import Window

    names = names or EMOTIONS
    name_arr = F.array(*[F.lit(n) for n in names])
    pc = per_class(confusion)
    w = Window.partitionBy()  # K rows, K = number of classes
    tot = F.sum("support").over(w)

    def row(cls, p, r, f, sup):
        return F.struct(cls.alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                        sup.cast("long").alias("support"))

    own = row(F.coalesce(F.element_at(name_arr, (F.col("cls") + 1).cast("int")), F.col("cls").cast("string")),
              F.col("precision"), F.col("recall"), F.col("f1"), F.col("support"))
    macro = row(F.lit("macro avg"), F.avg("precision").over(w), F.avg("recall").over(w), F.avg("f1").over(w), tot)
    weighted = row(F.lit("weighted avg"),
                   F.sum(F.col("support") * F.col("precision")).over(w) / tot,
                   F.sum(F.col("support") * F.col("recall")).over(w) / tot,
                   F.sum(F.col("support") * F.col("f1")).over(w) / tot, tot)
    first = F.col("cls") == F.min("cls").over(w)
    staged = pc.select(own.alias("own"), macro.alias("macro"), weighted.alias("weighted"), first.alias("first"))
    rows = F.when(F.col("first"), F.array("own", "macro", "weighted")).otherwise(F.array("own"))
    return staged.select(F.explode(rows).alias("r")).select("r.*")


def cross_entropy(label: str = "label", probs: str = "probs", eps: float = 1e-15) -> Column:
    """``-ln p[label]`` of a row, the probability clipped to eps."""
    p = F.element_at(F.col(probs), (F.col(label) + 1).cast("int"))
    return -F.log(F.least(F.greatest(p, F.lit(eps)), F.lit(1.0 - eps)))


def log_loss(scored: DataFrame, label: str = "label", probs: str = "probs", eps: float = 1e-15) -> DataFrame:
    """Mean cross-entropy.

    The reference averages per-batch means (over-weighting a short last
    batch); this is the true mean over rows.
    """
    return scored.agg(F.count(F.lit(1)).alias("n"), F.avg(cross_entropy(label, probs, eps)).alias("log_loss"))
