"""Alert rules over job events. A per-minute summary comes first; every rule reads only that.

The summary is a hash aggregate with a map-side part, so a job that writes a third of all events shuffles
one row per minute and task. It is the same expression for a batch table and for a stream, and it holds at
most one row per minute, job and component, which bounds the windows of the rules by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.series import Series, running

KEYS = ("job", "component")
# Alert levels; errors are counted per minute.
ERROR_LIMIT, FAILURE_LIMIT, STALE_SECONDS = 5, 0.1, 3600
SUSTAINED_MINUTES = {"data_ingestion": 15, "feature_engineering": 10, "training": 5}


def minute_summary(events: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Events (`ts`, keys, `ok`) per minute: counts and the last success and failure."""
    good = F.col("ok")
    sums = events.groupBy(F.window("ts", "1 minute").alias("w"), *keys).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(~good).alias("errors"),
        F.min(F.when(good, F.col("ts"))).alias("first_success"),
        F.max(F.when(good, F.col("ts"))).alias("last_success"),
        F.max(F.when(~good, F.col("ts"))).alias("last_failure"),
    )
    return sums.select(F.col("w.start").alias("minute"), *keys, "events", "errors", "first_success", "last_success", "last_failure")


def _sliding(summary: DataFrame, minutes: int, keys: Sequence[str]) -> DataFrame:
    """Event and error counts of the last `minutes` minutes, once a minute."""
    w = F.window("minute", f"{minutes} minutes", "1 minute")
    sums = summary.groupBy(w.alias("w"), *keys).agg(F.sum("events").alias("events"), F.sum("errors").alias("errors"))
    return sums.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "events", "errors")


def error_rate(summary: DataFrame, minutes: int = 5, limit: float = ERROR_LIMIT, keys: Sequence[str] = KEYS) -> DataFrame:
    """Windows with errors, their errors a minute, and whether these are over the limit."""
    windows = _sliding(summary, minutes, keys).filter("errors > 0").withColumn("errors_per_minute", F.col("errors") / minutes)
    return windows.withColumn("alert", F.col("errors_per_minute") > limit)


def failure_ratio(summary: DataFrame, minutes: int = 10, limit: float = FAILURE_LIMIT, keys: Sequence[str] = KEYS) -> DataFrame:
    """Share of failed events per window, and whether it is over the limit."""
    share = F.col("errors") / F.col("events")
    return _sliding(summary, minutes, keys).withColumn("failure_ratio", share).withColumn("alert", share > limit)


def stale_periods(summary: DataFrame, seconds: int = STALE_SECONDS, keys: Sequence[str] = KEYS) -> DataFrame:
    """Gaps without a success longer than `seconds`, up to the newest event of any job.

    `alerts.stale_alerts` also knows jobs that never succeeded.
    """
    newest = summary.agg(F.max(F.greatest("last_success", "last_failure")).alias("m")).scalar()
    good = summary.filter("last_success IS NOT NULL").select(*keys, "minute", "first_success", "last_success")
    near = running(good, _days(keys), {"_next": ("lead", "first_success")})
    gaps = near.select(*keys, F.col("last_success").alias("since"), F.coalesce("_next", newest).alias("until"))
    length = _micros("until") - _micros("since")
    return gaps.withColumn("gap_seconds", length / 1e6).filter(F.col("gap_seconds") > seconds)


def _days(keys: Sequence[str]) -> Series:
    return Series(key=tuple(keys), order="minute", bucket="day")


def _micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def sustained_failures(summary: DataFrame, minutes: int = 15, keys: Sequence[str] = KEYS) -> DataFrame:
    """Stretches in which the status, sampled once a minute, stays failed for at least `minutes`."""
    failed = F.coalesce(F.col("last_failure") >= F.col("last_success"), F.col("last_success").isNull())
    samples = summary.select(*keys, "minute", failed.alias("failed"), F.lit(1).alias("_one"))
    placed = running(samples, _days(keys), {"_place": ("sum", "_one"), "_before": ("lag", "failed")})
    turns = placed.filter(F.col("_before").isNull() | (F.col("_before") != F.col("failed"))).select(*keys, "minute", "failed", "_place")
    spans = running(turns, _days(keys), {"_until": ("lead", "minute"), "_next": ("lead", "_place")}).filter("failed")
    ends = summary.groupBy(*keys).agg(F.max("minute").alias("_last"), F.count(F.lit(1)).alias("_samples"))
    timed = spans.join(ends, [*keys]).withColumn("since", F.col("minute")).withColumn("until", F.coalesce("_until", "_last"))
    lasted = (_micros("until") - _micros("since")) / 60e6
    counted = F.coalesce("_next", F.col("_samples") + 1) - F.col("_place")
    return timed.withColumns({"minutes": lasted, "samples": counted}).filter(F.col("minutes") >= minutes).select(
        *keys, "since", "until", "minutes", "samples"
    )


def success_rate(summary: DataFrame, period: str = "1 day", keys: Sequence[str] = KEYS) -> DataFrame:
    sums = summary.groupBy(F.window("minute", period).alias("w"), *keys).agg(
        F.sum("events").alias("events"), F.sum("errors").alias("errors")
    )
    return sums.select(
        F.col("w.start").alias("period_start"), *keys, "events", (1.0 - F.col("errors") / F.col("events")).alias("success_rate")
    )
