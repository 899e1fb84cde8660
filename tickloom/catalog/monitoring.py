"""Queries: alert rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.catalog.registry import query
from tickloom.operators import monitoring as M
from tickloom.plans import inputs as I

LOG = """log AS (SELECT event_id, ts, event_type AS job, user_id % 10 AS component, event_type <> 'error' AS ok FROM events),
  comp AS (SELECT ts, component, ok FROM log)"""
COMPONENT = ("component",)


def log(spark, folder):
    return I.table(spark, folder, "events").select(
        "ts", F.col("event_type").alias("job"), F.pmod("user_id", F.lit(10)).alias("component"),
        (F.col("event_type") != "error").alias("ok"),
    )


def sliding(minutes: int, keys: str) -> str:
    return f"""windows AS (SELECT date_trunc('minute', ts) - to_minutes(o) AS window_start, date_trunc('minute', ts) - to_minutes(o) + to_minutes({minutes}) AS window_end,
      {keys}, count(*) AS events, count(*) FILTER (NOT ok) AS errors FROM log, range({minutes}) r(o) GROUP BY ALL)"""


@query(
    "r1_error_rate_5m",
    f"WITH {LOG}, {sliding(5, 'job, component')} -- result\n SELECT *, errors / 5 AS errors_per_minute, errors / 5 > 0.2 AS alert FROM windows WHERE errors > 0",
    doubles="errors_per_minute", dates="window_start window_end",
)
def r1(spark, folder):
    return M.error_rate(M.minute_summary(log(spark, folder)), limit=0.2)


@query(
    "r2_failure_ratio_10m",
    f"WITH {LOG}, {sliding(10, 'component')} -- result\n SELECT *, errors / events AS failure_ratio, errors / events > 0.1 AS alert FROM windows",
    doubles="failure_ratio", dates="window_start window_end",
)
def r2(spark, folder):
    return M.failure_ratio(M.minute_summary(log(spark, folder), COMPONENT), keys=COMPONENT)


@query(
    "r3_stale_ingest",
    f"""WITH {LOG}, s AS (SELECT component, ts AS since, coalesce(lead(ts) OVER (PARTITION BY component ORDER BY ts), (SELECT max(ts) FROM log)) AS until FROM comp WHERE ok)
    -- result
    SELECT *, (epoch_us(until) - epoch_us(since)) / 1e6 AS gap_seconds FROM s WHERE (epoch_us(until) - epoch_us(since)) / 1e6 > 3600""",
    doubles="gap_seconds", dates="since until",
)
def r3(spark, folder):
    return M.stale_periods(M.minute_summary(log(spark, folder), COMPONENT), keys=COMPONENT)


@query(
    "r4_sustained_failure",
    f"""WITH {LOG}, m AS (SELECT component, date_trunc('minute', ts) AS minute, NOT arg_max(ok, ts) AS failed FROM comp GROUP BY 1, 2),
    t AS (SELECT *, CAST(failed <> coalesce(lag(failed) OVER w, NOT failed) AS INTEGER) AS turn FROM m WINDOW w AS (PARTITION BY component ORDER BY minute)),
    i AS (SELECT *, sum(turn) OVER (PARTITION BY component ORDER BY minute) AS island FROM t),
    s AS (SELECT component, island, failed, min(minute) AS since, max(minute) AS lastm, count(*) AS samples FROM i GROUP BY 1, 2, 3),
    u AS (SELECT *, coalesce(lead(since) OVER (PARTITION BY component ORDER BY island), lastm) AS until FROM s)
    -- result
    SELECT component, since, until, (epoch(until) - epoch(since)) / 60 AS minutes, samples FROM u WHERE failed AND (epoch(until) - epoch(since)) / 60 >= 15""",
    doubles="minutes", dates="since until",
)
def r4(spark, folder):
    return M.sustained_failures(M.minute_summary(log(spark, folder), COMPONENT), keys=COMPONENT)


@query(
    "r5_success_rate",
    f"""WITH {LOG} -- result
    SELECT date_trunc('day', ts) AS period_start, component, count(*) AS events, avg(CAST(ok AS DOUBLE)) AS success_rate FROM comp, (SELECT 1) GROUP BY 1, 2""",
    doubles="success_rate", dates="period_start",
)
def r5(spark, folder):
    return M.success_rate(M.minute_summary(log(spark, folder), COMPONENT), keys=COMPONENT)
