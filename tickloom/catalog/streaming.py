"""Queries: streaming jobs run over what is available, checked against the batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.catalog import sql as S
from tickloom.catalog.monitoring import COMPONENT, LOG, sliding
from tickloom.catalog.registry import query
from tickloom.functions.labels import label_scores
from tickloom.functions.text import keyword_label, process_text
from tickloom.operators import monitoring as M
from tickloom.plans import inputs as I
from tickloom.streaming import jobs as J


@query("r7_stream_bars", f"WITH {S.BARS_HOURLY} -- result\n SELECT * FROM bars", doubles=S.OHLC, dates="date")
def r7(spark, folder):
    ticks = J.read_stream(spark, folder, "events.parquet").select("ts", "event_id", "value", F.col("event_type").alias("tic"))
    return J.bars_table(ticks)


def _log(spark, folder):
    return J.read_stream(spark, folder, "events.parquet").select(
        "ts", F.col("event_type").alias("job"), F.pmod("user_id", F.lit(10)).alias("component"),
        (F.col("event_type") != "error").alias("ok"),
    )


@query(
    "r1_error_rate_stream",
    f"WITH {LOG}, {sliding(5, 'job, component')} -- result\n SELECT *, errors / 5 AS errors_per_minute, errors / 5 > 0.2 AS alert FROM windows WHERE errors > 0",
    doubles="errors_per_minute", dates="window_start window_end",
)
def r1_stream(spark, folder):
    return M.error_rate(J.summary_table(_log(spark, folder), M.KEYS), limit=0.2)


@query(
    "r3_stale_ingest_stream",
    f"""WITH {LOG}, s AS (SELECT component, ts AS since, coalesce(lead(ts) OVER (PARTITION BY component ORDER BY ts), (SELECT max(ts) FROM log)) AS until FROM comp WHERE ok)
    -- result
    SELECT *, (epoch_us(until) - epoch_us(since)) / 1e6 AS gap_seconds FROM s WHERE (epoch_us(until) - epoch_us(since)) / 1e6 > 3600""",
    doubles="gap_seconds", dates="since until",
)
def r3_stream(spark, folder):
    return M.stale_periods(J.summary_table(_log(spark, folder), COMPONENT), keys=COMPONENT)


@query(
    "r6_stream_score_news",
    f"WITH {S.ALL_SCORED}, {S.DAILY_TIC} -- result\n SELECT * FROM daily",
    doubles=S.MEANS, dates="date",
)
def r6(spark, folder):
    def score(batch):
        cleaned = batch.withColumn("processed_text", process_text("summary"))
        labelled = cleaned.withColumn("label", keyword_label("processed_text", I.POSITIVE, I.NEGATIVE))
        return labelled.withColumns({**label_scores(F.col("label")), "date": F.to_date("published_at")})

    docs = J.read_stream(spark, folder, "documents.parquet")
    return J.sentiment_table(I.as_news(docs), score, unique="id")
