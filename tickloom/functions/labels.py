"""Sentiment labels: reading them from model output and spreading them to score columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.constants import SENTIMENTS

SCORE_COLUMNS = ("sentiment_positive", "sentiment_negative", "sentiment_neutral", "sentiment_unknown")


def parse_generated_label(generated: Column) -> Column:
    """Label after the first `Answer:`; `unknown` where there is none of the three."""
    word = F.lower(F.regexp_extract(generated, r"(?is)answer:\s*([^,.\s]*)", 1))
    return F.when(word.isin(*SENTIMENTS), word).otherwise(F.lit("unknown"))


def generated_score(label: Column) -> Column:
    return F.when(label == "unknown", F.lit(0.0)).otherwise(F.lit(1.0))


def normalize_class_label(label: Column) -> Column:
    """Class names and numbers of a classifier head as sentiment labels."""
    low = F.lower(label)
    return (
        F.when(low.isin("label_0", "0"), F.lit("negative"))
        .when(low.isin("label_1", "1"), F.lit("neutral"))
        .when(low.isin("label_2", "2"), F.lit("positive"))
        .when(low.isin(*SENTIMENTS), low)
        .otherwise(F.lit("unknown"))
    )


def label_scores(label: Column, score: Column | None = None) -> dict[str, Column]:
    """Four score columns of a label; a row without a known label is all `unknown`."""
    value = score if score is not None else F.lit(1.0)
    known = F.coalesce(label.isin(*SENTIMENTS), F.lit(False))
    out = {
        f"sentiment_{s}": F.when(known & (label == s), value).otherwise(F.lit(0.0)) for s in SENTIMENTS
    }
    out["sentiment_unknown"] = F.when(known, F.lit(0.0)).otherwise(F.lit(1.0))
    return out


def with_label_scores(df: DataFrame, label: str = "label", score: str | None = None) -> DataFrame:
    return df.withColumns(label_scores(F.col(label), F.col(score) if score else None))


def score_status(text: Column, model_available: bool, label: Column, score: Column) -> dict[str, Column]:
    """Label and score with the reason where there is none: no text, no model, or no result."""
    blank = text.isNull() | (text == "")
    if not model_available:
        missing, has = F.lit("unavailable"), F.lit(False)
    else:
        missing, has = F.lit("error"), label.isNotNull()
    return {
        "sentiment_label": F.when(blank, F.lit("n/a")).when(has, label).otherwise(missing),
        "sentiment_score": F.when(blank, F.lit(0.0)).when(has, score).otherwise(F.lit(0.0)),
    }
