"""Dense-vector and probability Column functions.

All arithmetic is done in double with left folds (``aggregate``) so results
are reproducible; vectors stored as ``array<float>`` are widened first.

Expressions with lambdas are written as Spark SQL text and parsed once by
``F.expr``: building the same tree through Python lambdas costs thousands of
driver round-trips per query. Arguments are SQL expressions - in practice
column names.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reverbkit.constants import EMOTIONS


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_doubles(col: Column | str) -> Column:
    return _c(col).cast("array<double>")


# -- SQL text builders ------------------------------------------------------

def sql_total(a: str) -> str:
    return f"aggregate({a}, 0D, (acc_, x_) -> acc_ + x_)"


def sql_dot(a: str, b: str) -> str:
    return f"aggregate(zip_with({a}, {b}, (x_, y_) -> x_ * y_), 0D, (acc_, x_) -> acc_ + x_)"


def sql_l2norm(a: str) -> str:
    return f"sqrt(aggregate({a}, 0D, (acc_, x_) -> acc_ + x_ * x_))"


def sql_names(names: list[str]) -> str:
    return "array(" + ", ".join("'" + n.replace("'", "''") + "'" for n in names) + ")"


def sql_top_k(probs: str, k: int = 3, names: list[str] | None = None) -> str:
    arr = sql_names(names or EMOTIONS)
    ranked = f"array_sort(transform({probs}, (x_, i_) -> named_struct('neg', -x_, 'idx', i_, 'p', x_)))"
    return (f"transform(slice({ranked}, 1, {int(k)}), "
            f"s_ -> named_struct('emotion', element_at({arr}, s_.idx + 1), 'conf', s_.p, 'idx', s_.idx))")


# -- Column functions ---------------------------------------------------------

def total(arr: str) -> Column:
    return F.expr(sql_total(arr))


def dot(a: str, b: str) -> Column:
    return F.expr(sql_dot(a, b))


def l2norm(a: str) -> Column:
    return F.expr(sql_l2norm(a))


def cosine(a: str, b: str) -> Column:
    """dot / (|a| |b|), 0 when either norm is 0."""
    den = f"({sql_l2norm(a)} * {sql_l2norm(b)})"
    return F.expr(f"CASE WHEN {den} > 0 THEN {sql_dot(a, b)} / {den} ELSE 0D END")


def softmax_exp(logits: str) -> Column:
    """exp(x - max) per element (first half of F14)."""
    return F.expr(f"zip_with({logits}, array_repeat(array_max({logits}), size({logits})), (x_, m_) -> exp(x_ - m_))")


def normalise(e: str) -> Column:
    """x / sum(x) per element (second half of F14)."""
    return F.expr(f"zip_with({e}, array_repeat({sql_total(e)}, size({e})), (x_, s_) -> x_ / s_)")


def softmax_sql(logits: str) -> str:
    e = f"zip_with({logits}, array_repeat(array_max({logits}), size({logits})), (x_, m_) -> exp(x_ - m_))"
    return f"zip_with({e}, array_repeat({sql_total(e)}, size({e})), (x_, s_) -> x_ / s_)"


def softmax(logits: str) -> Column:
    """numerically stable softmax over an array<double> column (for
    DataFrames prefer ``softmax_exp`` + ``normalise`` in two projections,
    which computes the exponentials once)."""
    return F.expr(softmax_sql(logits))


def top_k(probs: str, k: int = 3, names: list[str] | None = None) -> Column:
    """The k largest probabilities as array<struct<emotion, conf, idx>>.

    Ties go to the lower class index.
    """
    return F.expr(sql_top_k(probs, k, names))


def argmax(probs: str) -> Column:
    """Index of the largest value (first one on a tie), 0-based."""
    return F.expr(f"CAST(array_position({probs}, array_max({probs})) - 1 AS INT)")


def round_half_up(col: Column, places: int) -> Column:
    """Rounding that both Spark and DuckDB evaluate identically."""
    scale = float(10**places)
    return F.floor(col * scale + 0.5) / scale
