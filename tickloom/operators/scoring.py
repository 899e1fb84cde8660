"""Batch scoring with user-supplied models in Python workers."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Scorer = Callable[[list[str]], list[dict]]
BATCH = 32


def word_scorer(positive: Sequence[str], negative: Sequence[str]) -> Callable[[], Scorer]:
    """Factory of a scorer for single words: the side of which a text has more different words, with score 1."""
    sides = {w.lower(): 1 for w in positive} | {w.lower(): -1 for w in negative}
    names = {-1: "negative", 0: "neutral", 1: "positive"}

    def make() -> Scorer:
        def score(texts: list[str]) -> list[dict]:
            nets = (sum(sides[w] for w in set(re.findall(r"\w+", t.lower())) & sides.keys()) for t in texts)
            return [{"label": names[(n > 0) - (n < 0)], "score": 1.0} for n in nets]

        return score

    return make


def score_column(make: Callable[[], Scorer], batch: int = BATCH) -> Callable[[Column], Column]:
    """Column function (text -> label, score). The model is made once per worker task; blanks are not sent to it."""

    def run(batches):
        scorer = make()
        for texts in batches:
            given = texts[texts.notna() & (texts.str.strip() != "")]
            results = [r for start in range(0, len(given), batch) for r in scorer(given.iloc[start : start + batch].tolist())]
            known = pd.DataFrame({"label": [r["label"] for r in results], "score": [float(r["score"]) for r in results]}, index=given.index)
            yield known.reindex(texts.index).fillna({"score": 0.0}).astype({"label": object})

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "label string, score double")


def predict_sentiment(df: DataFrame, text: str, make: Callable[[], Scorer], batch: int = BATCH) -> DataFrame:
    """Rows with `label` and `score` of their text; blank texts get `unknown` and 0."""
    scored = df.withColumn("_s", score_column(make, batch)(F.col(text)))
    return scored.withColumns({
        "label": F.coalesce("_s.label", F.lit("unknown")), "score": F.coalesce("_s.score", F.lit(0.0)),
    }).drop("_s")


def predict_valid_only(df: DataFrame, text: str, make: Callable[[], Scorer], batch: int = BATCH) -> DataFrame:
    """Score only rows with text, in one pass: the text of other rows is not sent to the workers, and they stay unknown."""
    has_text = F.coalesce(F.col(text).rlike(r"(?U)\S"), F.lit(False))
    sent = df.withColumn("_sent", F.when(has_text, F.col(text)))
    return predict_sentiment(sent, "_sent", make, batch).drop("_sent")


def batch_predict(
    df: DataFrame, features: Sequence[str], make: Callable[[], Callable[[pd.DataFrame], Sequence[float]]],
    keep: Sequence[str], name: str = "action",
) -> DataFrame:
    """Predictions of a policy or regressor over a table of observations, Arrow batch by Arrow batch."""
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = make()
        for batch in batches:
            values = np.asarray(predict(batch[list(features)]), dtype=float)
            yield batch[list(keep)].assign(**{name: values})

    return df.select(*dict.fromkeys([*keep, *features])).mapInPandas(run, schema)
