"""Alert life cycles: batch against a minute-by-minute walk, and the state machine of the streams against both."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import alerts as A
from tickloom.operators import monitoring as M
from tickloom.plans.inputs import in_time_order
from tickloom.streaming import alerts as S
from tickloom.streaming import jobs as J

START = dt.datetime(2024, 3, 1, 22)  # the cases run over midnight
KEYS = ("job", "component")


def moment(minute):
    return START + dt.timedelta(minutes=minute)


def walk(on, hold):
    """Transitions of a condition given minute by minute."""
    out, since, fired = [], None, False
    for t, now in enumerate(on):
        if now:
            if since is None:
                since, fired = t, False
                if hold > 0:
                    out.append((t, "pending"))
            if not fired and t >= since + hold:
                out.append((t, "firing"))
                fired = True
        elif since is not None:
            out.append((t, "resolved" if fired else "inactive"))
            since = None
    return out


def conditions(seed, n=400):
    rng, on, now = random.Random(seed), [], False
    for _ in range(n):
        now = now if rng.random() < 0.8 else not now
        on.append(now)
    return on


def found(df):
    return sorted((r.component, r["at"], r.state) for r in df.collect())


@pytest.mark.parametrize("hold", [0, 1, 3, 10])
def test_machine_equals_walk(hold):
    for seed in range(30):
        on, life, out = conditions(seed), (None, False), []
        rng = random.Random(seed)
        for t, now in enumerate(on):
            # A condition that stays as it was need not be told.
            if t == 0 or now != on[t - 1] or t == len(on) - 1 or rng.random() < 0.3:
                life, events = S.live(life, hold, t, now)
                out += events
        assert out == walk(on, hold)


@pytest.mark.parametrize("hold", [0, 2, 7])
def test_sampled_condition(spark, hold):
    cases = {c: conditions(c) for c in range(6)}
    rows = [("j", c, moment(t)) for c, on in cases.items() for t, now in enumerate(on) if now]
    minutes = spark.createDataFrame(rows, "job string, component int, minute timestamp_ntz")
    as_of = F.lit(moment(399)).cast("timestamp_ntz")
    got = found(A.transitions(A.sampled_intervals(minutes, KEYS, as_of), KEYS, hold, as_of))
    assert got == sorted((c, moment(t), s) for c, on in cases.items() for t, s in walk(on, hold))


def test_status_holds_until_the_next_sample(spark):
    rows, want = [], []
    for c in range(6):
        rng, status, on = random.Random(c), False, []
        for t in range(400):
            if rng.random() < 0.15:
                status = rng.random() < 0.5
                rows.append(("training" if c % 2 else "data_ingestion", c, moment(t), status))
            on.append(status)
        want += [(c, moment(t), s) for t, s in walk(on, 5 if c % 2 else 15)]
    samples = spark.createDataFrame(rows, "job string, component int, minute timestamp_ntz, failed boolean")
    as_of = F.lit(moment(399)).cast("timestamp_ntz")
    got = A.transitions(A.status_intervals(samples, KEYS, as_of), KEYS, A.hold_minutes("job"), as_of)
    assert found(got) == sorted(want)


def test_nothing(spark):
    none = spark.createDataFrame([], "job string, component int, minute timestamp_ntz, failed boolean")
    as_of = F.lit(moment(0)).cast("timestamp_ntz")
    assert A.transitions(A.status_intervals(none, KEYS, as_of), KEYS, 3, as_of).count() == 0
    assert A.transitions(A.sampled_intervals(none, KEYS, as_of), KEYS, 3, as_of).count() == 0


@pytest.fixture(scope="module")
def events(spark):
    rng, rows = random.Random(9), []
    for c in range(5):
        t = 0.0
        while t < 900:
            t += rng.expovariate(1 / rng.choice([2, 30, 90]))
            rows.append(("training" if c % 2 else "data_ingestion", c, START + dt.timedelta(minutes=t), rng.random() < 0.5))
    return spark.createDataFrame(rows, "job string, component int, ts timestamp_ntz, ok boolean")


def feed(events):
    return J.read_stream(events.sparkSession, in_time_order(events, "ts", 5), "*.parquet", files_per_batch=1)


def closed(events):
    return F.lit(events.agg(F.date_trunc("minute", F.max("ts") - F.expr("INTERVAL 20 MINUTES"))).first()[0]).cast("timestamp_ntz")


@pytest.mark.parametrize("value, limit, hold", [("rate", 0.1, 4), ("ratio", 0.4, 0)])
def test_rate_stream_equals_batch(spark, events, value, limit, hold):
    want = found(A.rate_alerts(M.minute_summary(events), closed(events), value, 10, limit, hold))
    got = found(S.rate_table(feed(events), value, 10, limit, hold, delay="20 minutes"))
    assert got == want and len(want) > 20


def test_sustained_stream_equals_batch(spark, events):
    until = closed(events) - F.expr("INTERVAL 1 MINUTE")
    want = found(A.sustained_alerts(M.minute_summary(events), until, A.hold_minutes("job")))
    got = found(S.sustained_table(feed(events), M.SUSTAINED_MINUTES, delay="20 minutes"))
    assert got == want and {s for _, _, s in want} == {"pending", "firing", "resolved", "inactive"}


def test_silence_raises_the_alert(spark, events):
    """A job that never succeeds and one without any event are late by the time from which they are watched."""
    since = START - dt.timedelta(minutes=5)
    rows = [("training" if c % 2 else "data_ingestion", c, since) for c in (0, 1, 2, 3, 4, 7)]
    jobs = spark.createDataFrame(rows, "job string, component int, since timestamp_ntz")
    some = events.withColumn("ok", F.col("ok") & (F.col("component") != 3))
    want = found(A.stale_alerts(M.minute_summary(some), jobs, closed(some), 1200))
    got = found(S.stale_table(feed(some), jobs, 1200, delay="20 minutes"))
    assert got == want
    assert [x for x in want if x[0] in (3, 7)] == [(c, since + dt.timedelta(minutes=20), "firing") for c in (3, 7)]
