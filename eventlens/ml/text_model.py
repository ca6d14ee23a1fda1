"""Pluggable text-sentiment model.

``score_text`` runs a caller's model over Arrow batches with an iterator
pandas UDF: the model is built once per task (``scorer_factory``), each
batch of texts is scored in one call, labels are mapped (M13), the label is
the arg-max, and empty texts or a failing batch get the neutral scores.
Without a model the lexicon scorer (F03, plain columns) is used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.functions.text import EMPTY_SCORES, LABEL_NAMES, with_lexicon_sentiment

SCORE_SCHEMA = ("positive double, neutral double, negative double, predicted_sentiment string, "
                "confidence double, score_error string")
_ORDER = ("positive", "neutral", "negative")


def _neutral():
    p, u, n = EMPTY_SCORES
    return {"positive": p, "neutral": u, "negative": n, "predicted_sentiment": "neutral", "confidence": u}


def _row(scores: list[dict]) -> dict:
    named = {}
    for s in scores:
        label = s["label"]
        named[LABEL_NAMES.get(label, str(label).lower())] = float(s["score"])
    best = max(named, key=named.get)          # first maximum wins, in model order
    out = {k: named.get(k) for k in _ORDER}
    out.update(predicted_sentiment=best, confidence=named[best])
    return out


def score_text(df: DataFrame, text_col: str = "text",
               scorer_factory: Callable[[], Callable[[list[str]], list[list[dict]]]] | None = None,
               prefix: str = "sentiment_") -> DataFrame:
    """Add sentiment columns from a model (or the lexicon)."""
    if scorer_factory is None:
        return with_lexicon_sentiment(df, text_col, prefix=prefix)

    @F.pandas_udf(SCORE_SCHEMA)
    def _score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = scorer_factory()
        for texts in batches:
            rows = [_neutral()] * len(texts)
            idx = [i for i, t in enumerate(texts) if isinstance(t, str) and t]
            error, sent = None, set(idx)
            if idx:
                try:
                    results = model([texts.iloc[i] for i in idx])
                    for i, r in zip(idx, results):
                        rows[i] = _row(r)
                except Exception as failed:   # the texts of the batch stay neutral, and say why
                    error = f"{type(failed).__name__}: {failed}"
            out = pd.DataFrame(rows, columns=["positive", "neutral", "negative", "predicted_sentiment", "confidence"])
            yield out.assign(score_error=[error if error and i in sent else None for i in range(len(texts))])

    s = df.withColumn("_s", _score(F.col(text_col)))
    return s.select(*[c for c in df.columns], F.col("_s.positive").alias(f"{prefix}positive"),
                    F.col("_s.neutral").alias(f"{prefix}neutral"), F.col("_s.negative").alias(f"{prefix}negative"),
                    F.col("_s.predicted_sentiment").alias("predicted_sentiment"),
                    F.col("_s.confidence").alias("confidence"), F.col("_s.score_error").alias("score_error"))
