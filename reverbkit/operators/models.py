"""Extension points for user models (M5 option (c), M8, M12).

The reference calls a sentence encoder and a fine-tuned classifier from
Python. Here such a model plugs in through an *iterator* ``pandas_udf``:
Arrow batches stream through one Python worker per task, the model is loaded
once per task (not per row), and Spark still partitions, shuffles and joins
everything around it. The callables are the user's; nothing here is a
model.

* ``model_vectoriser(load)`` -> ``(df, text_col) -> df + vec`` for
  ``operators.pairing.nearest_chunk`` / ``plans.flow.run_analysis``;
  ``load()`` returns ``encode(list[str]) -> ndarray[n, dim]``.
* ``PandasModelScorer(load)`` -> ``score_text(df, text_col)``;
  ``load()`` returns ``predict(list[str]) -> ndarray[n, 6]`` of logits or
  probabilities (``softmax=True`` applies F14 on the JVM side).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reverbkit.constants import EMOTIONS
from reverbkit.functions.vectors import argmax, normalise, softmax_exp, top_k


def _array_udf(load: Callable[[], Callable[[list[str]], np.ndarray]]):
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fn = load()  # once per task
        for texts in batches:
            out = np.asarray(fn(texts.fillna("").tolist()), dtype="float64")
            yield pd.Series(list(out))

    return run


def model_vectoriser(load: Callable[[], Callable[[list[str]], np.ndarray]]):
    """Dense text vectors from a user encoder (M5 (c))."""
    udf = _array_udf(load)

    def vectorise(df: DataFrame, text_col: str) -> DataFrame:
        return df.withColumn("vec", udf(F.col(text_col)))

    return vectorise


@dataclass
class PandasModelScorer:
    """Six-way emotion scores from a user classifier (M8; M12 for summaries)."""

    load: Callable[[], Callable[[list[str]], np.ndarray]]
    logits: bool = True
    names: list[str] | None = None

    def score_text(self, df: DataFrame, text_col: str) -> DataFrame:
        raw = df.withColumn("_raw", _array_udf(self.load)(F.col(text_col)))
        if self.logits:
            raw = raw.withColumn("_ex", softmax_exp("_raw")).withColumn("probs", normalise("_ex"))
        else:
            raw = raw.withColumn("probs", F.col("_raw"))
        out = raw.drop("_raw", "_ex")
        return out.withColumn("top3", top_k("probs", 3, self.names or EMOTIONS)).withColumn(
            "pred", argmax("probs")
        )


def score_summaries(scorer, summaries: DataFrame, text_col: str = "summary") -> DataFrame:
    """Top-3 emotions of each supplied summary text, flattened."""
    s = scorer.score_text(summaries, text_col)
    return s.select(
        "*",
        *[F.element_at("top3", i)["emotion"].alias(f"summary_emotion{i}") for i in range(1, 4)],
        *[F.element_at("top3", i)["conf"].alias(f"summary_conf{i}") for i in range(1, 4)],
    ).drop("probs", "top3", "pred")
