"""Emotion-relationship scoring as Column expressions.

Inputs are top-3 arrays ``array<struct<emotion string, conf double, idx int>>``
for the comment and for its transcript chunk. Everything is row-local (no
shuffle); the 6x6 matrix is a constant-folded literal.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reverbkit.constants import (
    CES_LAMBDA,
    ECF_HIGH_AT_OR_BELOW,
    ECF_HIGH_MIN_CONF,
    ECF_NONE_ABOVE,
    EMOTIONS,
    IRONY_COMMENT,
    IRONY_TRANSCRIPT,
    NEGATIVE_EMOTIONS,
    RELATIONSHIP_MATRIX,
    SARCASM_COMMENT,
    SARCASM_TRANSCRIPT,
    SENTIMENT_MIN_CONF,
    WRS_BETA,
)


def sql_matrix() -> str:
    return "array(" + ", ".join(
        "array(" + ", ".join(f"{float(v)!r}D" for v in row) + ")" for row in RELATIONSHIP_MATRIX
    ) + ")"


def matrix_column() -> Column:
    return F.expr(sql_matrix())


def sql_relation(t_idx: str, c_idx: str) -> str:
    return f"try_element_at(try_element_at({sql_matrix()}, ({t_idx}) + 1), ({c_idx}) + 1)"


def relation(t_idx: Column, c_idx: Column) -> Column:
    """M[transcript][comment]; null for an unknown label."""
    return F.try_element_at(F.try_element_at(matrix_column(), t_idx + 1), c_idx + 1)


def ces_array(comment_top: str, transcript_top: str, lam: float = CES_LAMBDA) -> Column:
    """One CES per comment emotion, aligned with ``comment_top``.

    ``conf_c + lam * sum_t conf_t * M[t][c]`` folded left in top-3 order.
    Arguments are column names (SQL text).
    """
    step = f"acc_ + {float(lam)!r}D * (t_.conf * {sql_relation('t_.idx', 'c_.idx')})"
    return F.expr(f"transform({comment_top}, c_ -> aggregate({transcript_top}, c_.conf, (acc_, t_) -> {step}))")


def final_emotion(comment_top: str, ces: str) -> Column:
    """C4/T4: comment emotion with the largest CES, earliest rank on a tie."""
    return F.expr(f"element_at({comment_top}, CAST(array_position({ces}, array_max({ces})) AS INT)).emotion")


def wrs(comment_top: Column, transcript_top: Column, ces: Column, beta: float = WRS_BETA) -> Column:
    """conf_t1 * conf_c1 * M[t1][c1] + beta * CES[c1]."""
    c1 = F.element_at(comment_top, 1)
    t1 = F.element_at(transcript_top, 1)
    return t1["conf"] * c1["conf"] * relation(t1["idx"], c1["idx"]) + F.lit(beta) * F.element_at(ces, 1)


def ecf(wrs_col: Column, comment_top: Column, transcript_top: Column) -> Column:
    """Mismatch flag; null when there is none."""
    c1 = F.element_at(comment_top, 1)
    t1 = F.element_at(transcript_top, 1)
    high = (
        (wrs_col <= ECF_HIGH_AT_OR_BELOW)
        & (t1["conf"] > ECF_HIGH_MIN_CONF)
        & (c1["conf"] > ECF_HIGH_MIN_CONF)
    )
    none = F.lit(None).cast("string")
    return (
        F.when(wrs_col > ECF_NONE_ABOVE, none)
        .when(wrs_col > ECF_HIGH_AT_OR_BELOW, F.lit("moderate_mismatch"))
        .when(
            high & t1["emotion"].isin(SARCASM_TRANSCRIPT) & c1["emotion"].isin(SARCASM_COMMENT),
            F.lit("high_sarcasm"),
        )
        .when(
            high & t1["emotion"].isin(IRONY_TRANSCRIPT) & c1["emotion"].isin(IRONY_COMMENT),
            F.lit("high_irony"),
        )
        .otherwise(none)
    )


def ces_for(emotion: str, comment_top: str, ces: str) -> Column:
    """CES of one named emotion, null when it is not in the comment's top-3."""
    pos = f"CAST(array_position(transform({comment_top}, c_ -> c_.emotion), '{emotion}') AS INT)"
    return F.expr(f"CASE WHEN {pos} > 0 THEN element_at({ces}, {pos}) END")


def sentiment(top_emotion: Column, conf: Column) -> Column:
    """Conf < 0.5 -> Neutral; Anger/Sadness/Fear -> Negative; else Positive."""
    return (
        F.when(conf < SENTIMENT_MIN_CONF, F.lit("Neutral"))
        .when(top_emotion.isin(NEGATIVE_EMOTIONS), F.lit("Negative"))
        .otherwise(F.lit("Positive"))
    )


CES_COLUMNS = [e.lower() for e in EMOTIONS]
