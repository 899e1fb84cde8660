"""The one-day job: indicators, scored articles and combined features of one date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.labels import score_status
from tickloom.functions.text import first_nonempty, keyword_label, process_text
from tickloom.operators.features import add_run_mean
from tickloom.operators.indicators import technical_indicators
from tickloom.operators.series import DAILY, Series
from tickloom.sources.sinks import sink_parquet_if_nonempty


def day_indicators(bars: DataFrame, day: str, history_days: int | None = None, series: Series = DAILY) -> DataFrame:
    """Standard indicators of one day, computed from the rows up to it.

    `history_days` limits how far back is read; with None every earlier day counts.
    """
    d = F.lit(day).cast("date")
    past = bars.filter(F.col("date") <= d)
    if history_days is not None:
        past = past.filter(F.col("date") > F.date_sub(d, history_days))
    return technical_indicators(past, series=series).filter(F.col("date") == d)


def day_news(news: DataFrame, day: str, positive, negative, text: Column | None = None, model_available: bool = True) -> DataFrame:
    """Articles of the day with cleaned text, label and score, and the reason where there is none."""
    text = first_nonempty("headline", "summary") if text is None else text
    today = news.filter(F.col("date") == F.lit(day).cast("date")).withColumn("_text", text)
    cleaned = today.withColumn("processed_text", F.when(F.col("_text") == "", F.lit("")).otherwise(process_text("_text")))
    label = keyword_label("processed_text", positive, negative)
    status = score_status(F.col("_text"), model_available, label, F.lit(1.0))
    return cleaned.withColumns(status).drop("_text")


def day_features(indicators: DataFrame, scored: DataFrame) -> DataFrame:
    """Indicators with the day's mean article score on every row; NULL on a day without articles."""
    return add_run_mean(indicators, scored)


def write_day(base: str, day: str, indicators: DataFrame, scored: DataFrame, combined: DataFrame) -> dict[str, bool]:
    """The three tables of a day, each only if it has rows."""
    parts = {"technical_indicators": indicators, "processed_news": scored, "aggregated_features": combined}
    return {name: sink_parquet_if_nonempty(df, f"{base}/{name}/date={day}") for name, df in parts.items()}
