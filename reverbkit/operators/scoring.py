"""Centroid emotion scorer (M8 on vectors).

``CentroidScorer`` - class centroids from labelled vectors; logits are
``scale * cosine(v, centroid)``; softmax; pure Column code. Other scorers
with the same output (a ``probs`` array<double> column): ``train.ModelScorer``
/ ``flow.TextModelScorer`` (a fitted Spark ML pipeline) and
``models.PandasModelScorer`` (a user model in an iterator pandas UDF). Each
distinct text or chunk is scored once; results reach the comment rows as
search payloads (``pairing.nearest_chunk``) or by key joins
(``flow.predictions_from``) - J4, M9, M10.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame  # noqa: F401
from pyspark.sql import functions as F

from reverbkit.constants import CENTROID_LOGIT_SCALE, EMOTIONS
from reverbkit.functions.vectors import l2norm, normalise, softmax_exp, sql_dot

CENTROID_COL = "_centroids"


def centroid_table(labelled: DataFrame, vec_col: str = "vec", label_col: str = "label",
                   n_classes: int = len(EMOTIONS)) -> DataFrame:
    """One row: ``centroids array<struct<label, vec, norm>>`` ordered by label.

    Per-class vector sums use Spark ML's ``Summarizer`` (an imperative
    aggregate over whole vectors with map-side partial aggregation), so rows
    are not exploded per dimension; the result is bounded by
    ``n_classes x dim`` values whatever the input size. Cosine does not
    depend on scale, so sums stand in for means.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    per_class = (
        labelled.where(F.col(label_col).between(0, n_classes - 1))
        .groupBy(F.col(label_col).cast("int").alias("label"))
        .agg(Summarizer.metrics("sum").summary(array_to_vector(F.col(vec_col))).alias("_s"))
        .select("label", vector_to_array(F.col("_s.sum")).alias("vec"))
    )
    return per_class.agg(
        F.array_sort(
            F.collect_list(F.struct("label", "vec", l2norm("vec").alias("norm")))
        ).alias("centroids")
    )


@dataclass
class CentroidScorer:
    """Nearest-centroid soft classifier over dense vectors."""

    centroids: Column  # scalar-subquery column holding the centroid array
    scale: float = CENTROID_LOGIT_SCALE

    @classmethod
    def fit(cls, labelled: DataFrame, vec_col: str = "vec", label_col: str = "label",
            scale: float = CENTROID_LOGIT_SCALE) -> "CentroidScorer":
        # scalar(): evaluated once as an uncorrelated subquery and inlined as
        # a constant; its size is bounded by classes x dim.
        return cls(centroid_table(labelled, vec_col, label_col).scalar(), scale)

    def logits_sql(self, vec: str, norm: str, centroids: str) -> str:
        """``scale * cosine(vec, centroid)`` per class over column names."""
        cos = f"CASE WHEN (n_ * c_.norm) > 0 THEN {sql_dot(vec, 'c_.vec')} / (n_ * c_.norm) ELSE 0D END"
        return (f"zip_with({centroids}, array_repeat({norm}, size({centroids})), "
                f"(c_, n_) -> {float(self.scale)!r}D * {cos})")

    def score(self, df: DataFrame, vec_col: str = "vec", out: str = "probs") -> DataFrame:
        """Adds ``out`` = class probabilities of ``vec_col`` (narrow projections).

        Intermediate columns are real projections so no lambda re-computes
        the vector norm, the logits or the exponentials per class.
        """
        return (
            df.withColumn(CENTROID_COL, self.centroids)
            .withColumn("_vn", l2norm(vec_col))
            .withColumn("_lg", F.expr(self.logits_sql(vec_col, "_vn", CENTROID_COL)))
            .withColumn("_ex", softmax_exp("_lg"))
            .withColumn(out, normalise("_ex"))
            .drop(CENTROID_COL, "_vn", "_lg", "_ex")
        )
