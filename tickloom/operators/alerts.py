"""Life cycle of alerts over the per-minute summary of job events.

A condition that becomes true is pending; it fires once it has held for the time the rule asks for, and is resolved when it
ends. One that ends before is inactive again. Each rule is first turned into intervals in which its condition holds, then
into the transitions, a row each. Values of the neighbouring row are carried from day to day over a table of days, so
no task needs all minutes of a key. `tickloom.streaming.alerts` gives the same transitions from a stream.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.monitoring import KEYS, STALE_SECONDS, SUSTAINED_MINUTES
from tickloom.operators.series import Series, running

PENDING, FIRING, RESOLVED, INACTIVE = "pending", "firing", "resolved", "inactive"


def _days(keys: Sequence[str]) -> Series:
    return Series(key=tuple(keys), order="minute", bucket="day")


def later(time: Column, seconds: Column | float) -> Column:
    """`time` and some seconds more."""
    zero = F.lit(0)
    return time + F.make_dt_interval(zero, zero, zero, F.lit(seconds).cast("decimal(18,6)"))


def hold_minutes(job: str, minutes: Mapping[str, float] = SUSTAINED_MINUTES, default: float = 15) -> Column:
    """How long the condition of a job must hold, by the job's name."""
    chosen = F.lit(None)
    for name, value in minutes.items():
        chosen = F.when(F.col(job) == name, F.lit(float(value))).otherwise(chosen)
    return F.coalesce(chosen, F.lit(float(default)))


def sampled_intervals(minutes: DataFrame, keys: Sequence[str], as_of: Column) -> DataFrame:
    """(keys, since, until): stretches of neighbouring minutes of `minutes` (keys, minute), those in which a condition is true.

    `until` is the first minute without it, NULL if that is after `as_of`; later minutes are not looked at.
    """
    series, step = _days(keys), F.expr("INTERVAL 1 MINUTE")
    true = minutes.select(*keys, "minute").where(F.col("minute") <= as_of)
    near = running(true, series, {"_before": ("lag", "minute"), "_after": ("lead", "minute")})
    first = F.col("_before").isNull() | (F.col("minute") - F.col("_before") > step)
    last = F.col("_after").isNull() | (F.col("_after") - F.col("minute") > step)
    ends = near.select(*keys, "minute", first.alias("_first"), last.alias("_last")).where("_first or _last")
    paired = running(ends, series, {"_end": ("lead", "minute")}).where("_first")
    until = F.when(F.col("_last"), F.col("minute")).otherwise(F.col("_end")) + step
    return paired.select(*keys, F.col("minute").alias("since"), F.when(until <= as_of, until).alias("until"))


def status_intervals(samples: DataFrame, keys: Sequence[str], as_of: Column) -> DataFrame:
    """(keys, since, until): stretches in which `samples` (keys, minute, failed) are failed; a sample holds until the next.

    `until` is the minute of the first good sample, NULL if none came up to `as_of`; later samples are not looked at.
    """
    series = _days(keys)
    known = samples.select(*keys, "minute", "failed").where(F.col("minute") <= as_of)
    turned = running(known, series, {"_before": ("lag", "failed")})
    turned = turned.where(F.col("_before").isNull() | (F.col("_before") != F.col("failed"))).drop("_before")
    spans = running(turned, series, {"until": ("lead", "minute")}).where("failed")
    return spans.select(*keys, F.col("minute").alias("since"), "until")


def transitions(intervals: DataFrame, keys: Sequence[str], minutes: Column | float, as_of: Column) -> DataFrame:
    """(keys, at, state): what an alert goes through in each interval (keys, since, until), up to `as_of`.

    The condition must hold for `minutes`, the last of them included; with 0 it fires at once.
    """
    seconds = F.lit(minutes) * 60
    due = later(F.col("since"), seconds)
    fired = F.when(F.col("until").isNull(), due <= as_of).otherwise((due < F.col("until")) | (seconds == 0))
    event = lambda at, state: F.struct(at.alias("at"), state.alias("state"))
    events = F.array_compact(F.array(
        F.when(seconds > 0, event(F.col("since"), F.lit(PENDING))),
        F.when(fired, event(due, F.lit(FIRING))),
        F.when(F.col("until").isNotNull(), event(F.col("until"), F.when(fired, RESOLVED).otherwise(INACTIVE))),
    ))
    return intervals.select(*keys, F.explode(events).alias("event")).select(*keys, "event.*")


def rates(summary: DataFrame, minutes: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, minute, events, errors, rate, ratio): the last `minutes` minutes before each minute that has events in them.

    `rate` is errors a minute, `ratio` the share of errors.
    """
    w = F.window("minute", f"{minutes} minutes", "1 minute")
    sums = summary.groupBy(w.alias("w"), *keys).agg(F.sum("events").alias("events"), F.sum("errors").alias("errors"))
    return sums.select(
        *keys, F.col("w.end").alias("minute"), "events", "errors",
        (F.col("errors") / minutes).alias("rate"), (F.col("errors") / F.col("events")).alias("ratio"),
    )


def rate_alerts(
    summary: DataFrame, as_of: Column, value: str = "rate", window: int = 5, limit: float = 5, minutes: float = 0,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """(keys, at, state) of an alert on `value` (rate, errors a minute, or ratio) of the last `window` minutes over `limit`."""
    over = rates(summary, window, keys).where(F.col(value) > limit)
    return transitions(sampled_intervals(over, keys, as_of), keys, minutes, as_of)


def failed_minutes(summary: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, minute, failed): whether the last event of each minute is a failure."""
    failed = F.coalesce(F.col("last_failure") >= F.col("last_success"), F.col("last_success").isNull())
    return summary.select(*keys, "minute", failed.alias("failed"))


def sustained_alerts(summary: DataFrame, as_of: Column, minutes: Column | float, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, at, state) of an alert on a failed status that lasts for `minutes`, which may depend on the key."""
    return transitions(status_intervals(failed_minutes(summary, keys), keys, as_of), keys, minutes, as_of)


def stale_alerts(
    summary: DataFrame, jobs: DataFrame, as_of: Column, seconds: float = STALE_SECONDS, keys: Sequence[str] = KEYS
) -> DataFrame:
    """(keys, at, state) of an alert that fires `seconds` after the last success and is resolved by the next one.

    `jobs` (keys, since) lists the jobs that are watched and from when on: one that never succeeds is late by `since`. Jobs
    that are not listed are watched from their first success. Minutes from `as_of` on are not looked at.
    """
    good = summary.where(F.col("last_success").isNotNull() & (F.col("minute") < as_of))
    good = good.select(*keys, "minute", "first_success", "last_success")
    known = jobs.select(*keys, F.date_trunc("minute", "since").cast(summary.schema["minute"].dataType).alias("minute"), F.col("since").alias("first_success"), F.col("since").alias("last_success"))
    marks = good.unionByName(known.where(F.col("minute") < as_of))
    # A job may succeed in the minute from which it is watched.
    marks = marks.groupBy(*keys, "minute").agg(F.min("first_success").alias("first_success"), F.max("last_success").alias("last_success"))
    gaps = running(marks, _days(keys), {"until": ("lead", "first_success")})
    due = later(F.col("last_success"), seconds)
    late = gaps.withColumn("due", due).where(F.col("due") < F.coalesce("until", as_of))
    event = lambda at, state: F.struct(at.alias("at"), F.lit(state).alias("state"))
    events = F.array_compact(F.array(event(F.col("due"), FIRING), F.when(F.col("until").isNotNull(), event(F.col("until"), RESOLVED))))
    return late.select(*keys, F.explode(events).alias("event")).select(*keys, "event.*")
