"""Alert rules as streams with state per key: the transitions of `tickloom.operators.alerts`, as they become known.

A windowed aggregate closes the minutes of each key behind the watermark; a stateful processor takes them in order. Its
timers wake a key that is silent, so silence itself can raise or end an alert. A minute is counted from the epoch.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from tickloom.operators.alerts import FIRING, INACTIVE, PENDING, RESOLVED
from tickloom.operators.monitoring import KEYS, STALE_SECONDS, minute_summary
from tickloom.session import cut
from tickloom.streaming.jobs import event_time, run_to_store

MINUTE_MS, MINUTE_US = 60_000, 60_000_000
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

Life = tuple[int | None, bool]  # since which minute the condition holds, and whether the alert fired


def live(life: Life, hold: float, at: int, on: bool) -> tuple[Life, list[tuple[float, str]]]:
    """The life of an alert after its condition is seen at minute `at`, and the transitions up to then.

    Between two calls the condition is as it was at the first.
    """
    (since, fired), out = life, []
    if since is not None and not fired and hold > 0 and (since + hold < at or (on and since + hold == at)):
        out.append((since + hold, FIRING))
        fired = True
    if on and since is None:
        out.append((at, PENDING if hold > 0 else FIRING))
        since, fired = at, hold <= 0
    elif not on and since is not None:
        out.append((at, RESOLVED if fired else INACTIVE))
        since, fired = None, False
    return (since, fired), out


class AlertProcessor(StatefulProcessor):
    """Keeps the life of each key's alert; subclasses turn closed minutes into a condition."""

    def __init__(self, keys: Sequence[str], holds: float | Mapping[str, float], default: float = 15):
        self.keys, self.holds, self.default = tuple(keys), holds, default

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.life = handle.getValueState("life", "since bigint, fired boolean, seen bigint")

    def hold(self, key: tuple) -> float:
        """Minutes that the condition must hold; by job where `holds` is a mapping, the job being the first key."""
        return float(self.holds.get(key[0], self.default) if isinstance(self.holds, Mapping) else self.holds)

    def get(self) -> tuple[Life, int | None]:
        since, fired, seen = self.life.get() if self.life.exists() else (None, False, None)
        return (since, bool(fired)), seen

    def wake(self, minute: float | None) -> None:
        """Have a timer go off when the watermark reaches a minute, and no other one."""
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if minute is not None:
            self.handle.registerTimer(int(minute * MINUTE_MS) - 1)

    def rows(self, key: tuple, events: list[tuple[float, str]]) -> Iterator[pd.DataFrame]:
        if events:
            own = {k: [v] * len(events) for k, v in zip(self.keys, key, strict=True)}
            yield pd.DataFrame({**own, "at": [round(t * MINUTE_US) for t, _ in events], "state": [s for _, s in events]})

    def close(self) -> None:
        pass


def _frame(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(rows)).sort_values("m")


class RateProcessor(AlertProcessor):
    """Condition: errors a minute, or the share of errors, of the last `window` minutes is over a limit."""

    def __init__(self, keys: Sequence[str], value: str, window: int, limit: float, minutes: float):
        super().__init__(keys, minutes)
        self.value, self.window, self.limit = value, window, limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.recent = handle.getMapState("recent", "minute bigint", "events bigint, errors bigint")

    def over(self, events: int, errors: int) -> bool:
        return events > 0 and (errors / self.window if self.value == "rate" else errors / events) > self.limit

    def advance(self, key: tuple, closed: list[tuple[int, int, int]], upto: int | None) -> Iterator[pd.DataFrame]:
        """Take in closed minutes (minute, events, errors), then judge all minutes up to `upto`."""
        (life, seen), out = self.get(), []
        recent = {m[0]: tuple(v) for m, v in self.recent.iterator()}
        stored = dict(recent)

        def judge(last: int) -> None:
            nonlocal life, seen, recent
            while recent and (seen is None or seen < last):
                # Minutes without events in their window have no condition; the first one that has is right behind an event.
                at = min(recent) + 1 if seen is None else max(seen + 1, min(recent) + 1)
                if at > last:
                    break
                recent = {m: v for m, v in recent.items() if m >= at - self.window}
                sums = [sum(v[i] for m, v in recent.items() if m < at) for i in (0, 1)]
                life, events = live(life, self.holds, at, self.over(*sums))
                out.extend(events)
                seen = at

        for minute, events, errors in closed:
            judge(minute)
            recent[minute] = (events, errors)
        if upto is not None:
            judge(upto)
        for m in stored.keys() - recent.keys():
            self.recent.removeKey((m,))
        for m in recent.keys() - stored.keys():
            self.recent.updateValue((m,), recent[m])
        self.life.update((*life, seen))
        self.wake(max(seen or 0, min(recent)) + 1 if recent else None)
        yield from self.rows(key, out)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        frame = _frame(rows)
        closed = list(zip(frame["m"].tolist(), frame["events"].tolist(), frame["errors"].tolist(), strict=True))
        yield from self.advance(key, closed, None)

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self.advance(key, [], timerValues.getCurrentWatermarkInMs() // MINUTE_MS)


class StatusProcessor(AlertProcessor):
    """Condition: the last event of the newest minute with events is a failure."""

    def settle(self, key: tuple, life: Life, out: list[tuple[float, str]]) -> Iterator[pd.DataFrame]:
        self.life.update((*life, None))
        since, fired = life
        # What happened in the minute in which it is due must be known.
        self.wake(None if since is None or fired else since + self.hold(key) + 1)
        yield from self.rows(key, out)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        (life, _), out, frame = self.get(), [], _frame(rows)
        for at, on in zip(frame["m"].tolist(), frame["failed"].tolist(), strict=True):
            life, events = live(life, self.hold(key), at, on)
            out += events
        yield from self.settle(key, life, out)

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        life, _ = self.get()
        known = timerValues.getCurrentWatermarkInMs() // MINUTE_MS - 1
        life, out = live(life, self.hold(key), known, life[0] is not None)
        yield from self.settle(key, life, out)


class StaleProcessor(AlertProcessor):
    """Fires some seconds after the last success, which a timer notices. Here `since` is that success in microseconds."""

    def __init__(self, keys: Sequence[str], seconds: float):
        super().__init__(keys, 0)
        self.micros = round(seconds * 1_000_000)

    def settle(self, since: int, fired: bool) -> None:
        self.life.update((since, fired, None))
        # A success in the minute in which it is due must be known.
        self.wake(None if fired else (since + self.micros) // MINUTE_US + 1)

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: TimerValues) -> None:
        self.settle(int(initialState["since"].min()), False)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        frame = _frame(rows)
        frame = frame[frame["last"].notna()]
        if not len(frame):
            return
        (since, fired), _ = self.get()
        out = []
        for first, last in zip(frame["first"].astype("int64").tolist(), frame["last"].astype("int64").tolist(), strict=True):
            if since is not None and (fired or first - since > self.micros):
                if not fired:
                    out.append(((since + self.micros) / MINUTE_US, FIRING))
                out.append((first / MINUTE_US, RESOLVED))
            since, fired = max(last, since or last), False
        self.settle(since, fired)
        yield from self.rows(key, out)

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        (since, _), _ = self.get()
        self.settle(since, True)
        yield from self.rows(key, [((since + self.micros) / MINUTE_US, FIRING)])


@contextmanager
def _rocks(spark: SparkSession) -> Iterator[None]:
    """State with timers needs this store; the session's own setting is put back."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def alert_stream(events: DataFrame, processor: AlertProcessor, delay: str, jobs: DataFrame | None = None) -> DataFrame:
    """Stream of (keys, at, state) from a stream of job events (`ts`, keys, `ok`), which may be late by `delay`.

    `jobs` (keys, since) is the state that keys start from, also those without any event.
    """
    keys = list(processor.keys)
    minutes = minute_summary(event_time(events, "ts", delay), keys)
    failed = F.coalesce(F.col("last_failure") >= F.col("last_success"), F.col("last_success").isNull())
    # Numbers instead of times, whose zone would depend on the session.
    closed = minutes.select(
        *keys, "minute", (F.unix_micros("minute") / MINUTE_US).cast("bigint").alias("m"), "events", "errors",
        failed.alias("failed"), F.unix_micros("first_success").alias("first"), F.unix_micros("last_success").alias("last"),
    )
    schema = T.StructType([*(closed.schema[k] for k in keys), T.StructField("at", T.LongType()), T.StructField("state", T.StringType())])
    initial = None
    if jobs is not None:
        # A table of its own: a stream cannot run subqueries of the state it starts from.
        initial = cut(jobs.select(*keys, F.unix_micros(F.col("since").cast("timestamp")).alias("since")), "jobs").groupBy(*keys)
    found = closed.groupBy(*keys).transformWithStateInPandas(processor, schema, "append", "eventTime", initial)
    return found.withColumn("at", F.timestamp_micros("at"))


def alert_table(events: DataFrame, processor: AlertProcessor, delay: str = "10 minutes", jobs: DataFrame | None = None) -> DataFrame:
    """The transitions of alert_stream() over what is available."""
    with _rocks(events.sparkSession):
        return run_to_store(alert_stream(events, processor, delay, jobs), mode="append").read().drop("batch_id")


def rate_table(events: DataFrame, value: str = "rate", window: int = 5, limit: float = 5, minutes: float = 0, keys: Sequence[str] = KEYS, delay: str = "10 minutes") -> DataFrame:
    return alert_table(events, RateProcessor(keys, value, window, limit, minutes), delay)


def sustained_table(events: DataFrame, minutes: float | Mapping[str, float], keys: Sequence[str] = KEYS, delay: str = "10 minutes") -> DataFrame:
    return alert_table(events, StatusProcessor(keys, minutes), delay)


def stale_table(events: DataFrame, jobs: DataFrame, seconds: float = STALE_SECONDS, keys: Sequence[str] = KEYS, delay: str = "10 minutes") -> DataFrame:
    return alert_table(events, StaleProcessor(keys, seconds), delay, jobs)
