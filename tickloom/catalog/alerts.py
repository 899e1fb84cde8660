"""Queries: life cycles of alerts, in batch and as streams with state, against the same SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.catalog.monitoring import log
from tickloom.catalog.registry import query
from tickloom.operators import alerts as A
from tickloom.operators import monitoring as M
from tickloom.plans import inputs as I
from tickloom.streaming import alerts as S
from tickloom.streaming import jobs as J

JOBS = tuple(M.SUSTAINED_MINUTES)
DELAY = "1 hour"  # how late an event of the streams may be; batch forms look at the same minutes

LOG = f"""log AS (SELECT list_extract({list(JOBS)}, CAST(user_id % 10 % 3 AS INTEGER) + 1) AS job, user_id % 10 AS component, ts,
    event_type <> 'error' AS ok FROM events),
  known AS (SELECT date_trunc('minute', max(ts) - INTERVAL 1 HOUR) AS as_of, date_trunc('day', min(ts)) - INTERVAL 2 HOUR AS since FROM events)"""


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Job events: every component belongs to a job."""
    job = F.element_at(F.array(*[F.lit(j) for j in JOBS]), (F.pmod("component", F.lit(len(JOBS))) + 1).cast("int"))
    return log(spark, folder).withColumn("job", job)


def stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same events from four files in order of time, each a micro-batch."""
    return J.read_stream(spark, I.in_time_order(events(spark, folder), "ts", 4), "*.parquet", files_per_batch=1)


def as_of(spark: SparkSession, folder: str) -> Column:
    newest = I.table(spark, folder, "events").agg(F.date_trunc("minute", F.max("ts") - F.expr(f"INTERVAL {DELAY}")).cast("timestamp_ntz").alias("m"))
    return newest.scalar()


def watched(spark: SparkSession, folder: str) -> DataFrame:
    """All jobs, two hours before their first day, and one that never ran."""
    log = events(spark, folder)
    jobs = log.select("job", "component").distinct()
    jobs = jobs.unionByName(jobs.limit(1).select(F.lit(JOBS[-1]).alias("job"), F.lit(99).cast("bigint").alias("component")))
    since = log.agg((F.date_trunc("day", F.min("ts")) - F.expr("INTERVAL 2 HOURS")).cast("timestamp_ntz").alias("since"))
    return jobs.withColumn("since", since.scalar())


def life(minutes: str, until: str = "as_of") -> str:
    """Transitions of the intervals iv (job, component, since, until)."""
    return f"""held AS (SELECT *, since + to_seconds(CAST({minutes} * 60 AS BIGINT)) AS due FROM iv),
  judged AS (SELECT *, CASE WHEN until IS NULL THEN due <= (SELECT {until} FROM known) ELSE due < until END AS fired FROM held)
  -- result
  SELECT job, component, since AS "at", 'pending' AS state FROM judged
  UNION ALL SELECT job, component, due, 'firing' FROM judged WHERE fired
  UNION ALL SELECT job, component, until, CASE WHEN fired THEN 'resolved' ELSE 'inactive' END FROM judged WHERE until IS NOT NULL"""


def rate(condition: str, minutes: int) -> str:
    return f"""WITH {LOG},
  windows AS (SELECT job, component, date_trunc('minute', ts) + to_minutes(o + 1) AS minute, count(*) AS events, count(*) FILTER (NOT ok) AS errors
    FROM log, range(60) r(o) GROUP BY ALL),
  hot AS (SELECT *, minute - to_minutes(CAST(row_number() OVER (PARTITION BY job, component ORDER BY minute) AS INTEGER)) AS island
    FROM windows, known WHERE {condition} AND minute <= as_of),
  iv AS (SELECT job, component, min(minute) AS since, CASE WHEN max(minute) < any_value(as_of) THEN max(minute) + INTERVAL 1 MINUTE END AS until
    FROM hot GROUP BY job, component, island),
  {life(str(minutes))}"""


ERRORS, RATIO = rate("errors / 60 > 1.0 / 60", 10), rate("errors / events > 0.25", 5)


@query("r1_error_rate_alerts", ERRORS, dates='"at"')
def r1(spark, folder):
    return A.rate_alerts(M.minute_summary(events(spark, folder)), as_of(spark, folder), "rate", 60, 1 / 60, 10)


@query("r1_error_rate_alerts_stream", ERRORS, dates='"at"')
def r1_stream(spark, folder):
    return S.rate_table(stream(spark, folder), "rate", 60, 1 / 60, 10, delay=DELAY)


@query("r2_failure_ratio_alerts", RATIO, dates='"at"')
def r2(spark, folder):
    return A.rate_alerts(M.minute_summary(events(spark, folder)), as_of(spark, folder), "ratio", 60, 0.25, 5)


@query("r2_failure_ratio_alerts_stream", RATIO, dates='"at"')
def r2_stream(spark, folder):
    return S.rate_table(stream(spark, folder), "ratio", 60, 0.25, 5, delay=DELAY)


STALE = f"""WITH {LOG},
  good AS (SELECT job, component, ts FROM log, known WHERE ok AND ts < as_of
    UNION ALL SELECT DISTINCT job, component, since FROM log, known UNION ALL SELECT '{JOBS[-1]}', 99, since FROM known),
  gaps AS (SELECT *, ts + INTERVAL 1 HOUR AS due, lead(ts) OVER (PARTITION BY job, component ORDER BY ts) AS until FROM good),
  late AS (SELECT gaps.* FROM gaps, known WHERE due < coalesce(until, as_of))
  -- result
  SELECT job, component, due AS "at", 'firing' AS state FROM late UNION ALL SELECT job, component, until, 'resolved' FROM late WHERE until IS NOT NULL"""


@query("r3_stale_alerts", STALE, dates='"at"')
def r3(spark, folder):
    return A.stale_alerts(M.minute_summary(events(spark, folder)), watched(spark, folder), as_of(spark, folder))


@query("r3_stale_stream_timer", STALE, dates='"at"')
def r3_stream(spark, folder):
    return S.stale_table(stream(spark, folder), watched(spark, folder), delay=DELAY)


HOLDS = "CASE job " + " ".join(f"WHEN '{j}' THEN {m}" for j, m in M.SUSTAINED_MINUTES.items()) + " END"
SUSTAINED = f"""WITH {LOG},
  samples AS (SELECT job, component, date_trunc('minute', ts) AS minute, NOT arg_max(ok, ts) AS failed FROM log GROUP BY ALL),
  seen AS (SELECT samples.*, lag(failed) OVER (PARTITION BY job, component ORDER BY minute) AS earlier FROM samples, known WHERE minute < as_of),
  turns AS (SELECT *, lead(minute) OVER (PARTITION BY job, component ORDER BY minute) AS until FROM seen WHERE earlier IS DISTINCT FROM failed),
  iv AS (SELECT job, component, minute AS since, until FROM turns WHERE failed),
  {life(HOLDS, "as_of - INTERVAL 1 MINUTE")}"""


@query("r4_sustained_by_job", SUSTAINED, dates='"at"')
def r4(spark, folder):
    until = as_of(spark, folder) - F.expr("INTERVAL 1 MINUTE")
    return A.sustained_alerts(M.minute_summary(events(spark, folder)), until, A.hold_minutes("job"))


@query("r4_sustained_stream", SUSTAINED, dates='"at"')
def r4_stream(spark, folder):
    return S.sustained_table(stream(spark, folder), M.SUSTAINED_MINUTES, delay=DELAY)
