"""Queries: profiles, drift, label quality and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.catalog import sql as S
from tickloom.catalog.registry import query
from tickloom.operators import drift as D
from tickloom.operators import profile as P
from tickloom.operators import sketches as SK
from tickloom.plans import inputs as I
from tickloom.session import scratch_path
from tickloom.session import cut


def _describe(column: str, table: str) -> str:
    return (
        f"SELECT '{column}' AS \"column\", count({column}) AS count, CAST(avg({column}) AS DOUBLE) AS mean, stddev_samp({column}) AS std, "
        f"CAST(min({column}) AS DOUBLE) AS min, CAST(max({column}) AS DOUBLE) AS max, quantile_cont(CAST({column} AS DOUBLE), 0.25) AS p25, "
        f"quantile_cont(CAST({column} AS DOUBLE), 0.5) AS p50, quantile_cont(CAST({column} AS DOUBLE), 0.75) AS p75 FROM {table}"
    )


LINE = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "a9_profile_describe",
    "-- result\n" + " UNION ALL ".join(_describe(c, "lineitem") for c in LINE),
    doubles="mean std min max p25 p50 p75", digits=4,
)
def a9(spark, folder):
    return P.describe_numeric(I.table(spark, folder, "lineitem").select(*LINE))


def _sketched(spark, folder):
    """Sketches of each ship month, written once."""
    line = I.table(spark, folder, "lineitem")
    return line, cut(SK.daily_sketches(line, F.date_trunc("month", "l_shipdate"), LINE), "sketches")


@query(
    "a9_profile_describe_approx",
    "-- result\n" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS count, true AS p25_ok, true AS p50_ok, true AS p75_ok, true AS distinct_ok FROM lineitem" for c in LINE),
)
def a9_approx(spark, folder):
    """Quartiles and distinct counts merged from monthly sketches lie within their error bounds."""
    line, state = _sketched(spark, folder)
    return SK.measured(line, SK.described(SK.merged(state)), LINE)


@query(
    "a9_sketched_moments",
    "-- result\n" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", year(l_shipdate) AS y, count({c}) AS count, CAST(avg({c}) AS DOUBLE) AS mean, stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM lineitem GROUP BY 2" for c in LINE),
    doubles="mean std min max", digits=4,
)
def a9_moments(spark, folder):
    """Counts, means, deviations and extremes of each year from the monthly sketches."""
    _, state = _sketched(spark, folder)
    years = SK.merged(state.withColumn("y", F.year("day").cast("bigint")), ("column", "y"))
    return SK.described(years).drop("p25", "p50", "p75", "distinct")


def _top(column: str) -> str:
    return (
        f"SELECT '{column}' AS \"column\", (SELECT count({column}) FROM orders) AS count, (SELECT count(DISTINCT {column}) FROM orders) AS \"unique\", "
        f"CAST(v AS VARCHAR) AS top, n AS freq FROM (SELECT {column} AS v, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, CAST(v AS VARCHAR) LIMIT 1)"
    )


@query(
    "a9_profile_describe_text",
    "-- result\n" + " UNION ALL ".join(f"SELECT * FROM ({_top(c)})" for c in ("o_orderpriority", "o_orderstatus", "o_custkey")),
)
def a9_text(spark, folder):
    return P.describe_text(I.table(spark, folder, "orders"), ["o_orderpriority", "o_orderstatus", "o_custkey"])


@query(
    "a10_null_counts",
    """WITH j AS (SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
    -- result
    SELECT 'doc_id' AS "column", count(*) - count(doc_id) AS nulls FROM j UNION ALL SELECT 'quality', count(*) - count(quality) FROM j
      UNION ALL SELECT 'toxic', count(*) - count(toxic) FROM j""",
)
def a10(spark, folder):
    joined = I.table(spark, folder, "documents").select("doc_id").join(I.table(spark, folder, "labels"), "doc_id", "left")
    return P.null_counts(joined)


@query(
    "a11_row_col_ticker_counts",
    f"WITH {S.BARS_LONG} -- result\n SELECT count(*) AS rows, CAST(7 AS BIGINT) AS columns, count(DISTINCT tic) AS tickers FROM bars",
)
def a11(spark, folder):
    return P.table_counts(I.bars_long(spark, folder))


@query("a12_date_bounds", f"WITH {S.BARS_LONG} -- result\n SELECT min(date) AS first, max(date) AS last FROM bars", dates="first last")
def a12(spark, folder):
    line = I.table(spark, folder, "lineitem").join(
        I.table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey")), "l_partkey", "left_semi"
    )
    return P.date_bounds(line.select(F.to_date("l_shipdate").alias("date")))


NUM = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "a13_corr_matrix",
    "-- result\n" + " UNION ALL ".join(
        f"SELECT '{a}' AS left_column, '{b}' AS right_column, corr({a}, {b}) AS correlation FROM lineitem" for a in NUM for b in NUM
    ),
    doubles="correlation",
)
def a13(spark, folder):
    return P.correlation_matrix(I.table(spark, folder, "lineitem"), NUM)


@query(
    "a14_monthly_resample_mean",
    f"""WITH {S.BARS_LONG}, m AS (SELECT last_day(date) AS month, avg(volume) AS volume FROM bars WHERE quarter(date) <> 2 GROUP BY 1),
    months AS (SELECT CAST(last_day(unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-11-01', INTERVAL 1 MONTH))) AS DATE) AS month)
    -- result
    SELECT months.month, m.volume FROM months LEFT JOIN m ON months.month = m.month""",
    doubles="volume", dates="month",
)
def a14(spark, folder):
    """Months of the second quarter have no rows and stay in the result."""
    bars = I.bars_long(spark, folder).filter(F.quarter("date") != 2)
    return P.monthly_mean(bars, ["volume"])


@query(
    "a15_histogram",
    """WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events), b AS (SELECT least(CAST(floor((value - lo) / (hi - lo) * 20) AS BIGINT) + 1, 20) AS bin,
      count(*) AS n FROM events, e GROUP BY 1)
    -- result
    SELECT CAST(r.bin AS BIGINT) AS bin, lo + (r.bin - 1) * (hi - lo) / 20 AS from_value, coalesce(n, 0) AS n FROM range(1, 21) r(bin) CROSS JOIN e LEFT JOIN b ON b.bin = r.bin""",
    doubles="from_value",
)
def a15(spark, folder):
    return P.histogram(I.ticks(spark, folder), "value", 20)


@query("a16_ticker_series", f"WITH {S.BARS_HOURLY} -- result\n SELECT date, volume FROM bars WHERE tic = 'view' ORDER BY date", dates="date")
def a16(spark, folder):
    return P.ticker_series(I.bars_hourly(spark, folder), "view", "volume")


@query(
    "a17_fetch_coverage",
    """-- result
    SELECT count(*) AS attempted, count(*) FILTER (c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')) AS fetched,
      count(*) FILTER (c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')) AS failed FROM customer""",
)
def a17(spark, folder):
    asked = I.table(spark, folder, "customer").select(F.col("c_custkey").alias("tic"))
    got = I.table(spark, folder, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("tic"))
    return P.fetch_coverage(asked, got)


@query("a18_source_counts", "-- result\n SELECT source AS source_name, count(*) AS n FROM documents GROUP BY 1")
def a18(spark, folder):
    return P.counts_by(I.news(spark, folder), "source_name")


@query(
    "a19_label_distribution",
    f"""WITH {S.NEWS}, {S.CLEANED}, {S.LABELLED} -- result
    SELECT source_name, label, count(*) AS n FROM labelled GROUP BY ROLLUP (source_name, label)""",
)
def a19(spark, folder):
    return P.label_distribution(I.labelled_news(spark, folder), "source_name", "label")


HALVES = f"""{S.BARS_HOURLY}, ref AS (SELECT * FROM bars WHERE date < TIMESTAMP '2024-01-16'),
  cur AS (SELECT date, tic, open, high, low, close * 1.2 AS close, volume FROM bars WHERE date >= TIMESTAMP '2024-01-16')"""


def _halves(spark, folder):
    """First half of the hourly bars, and the second half with closes a fifth higher."""
    bars = cut(I.bars_hourly(spark, folder), "bars")
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    later = bars.filter(F.col("date") >= middle).withColumn("close", F.col("close") * 1.2)
    return bars.filter(F.col("date") < middle), later


def _shift(c: str) -> str:
    return f"SELECT '{c}' AS \"column\", (SELECT avg({c}) FROM ref) AS reference_mean, (SELECT avg({c}) FROM cur) AS current_mean"


SHIFTS = f"""{HALVES}, means AS ({" UNION ALL ".join(_shift(c) for c in ("open", "high", "low", "close", "volume"))}),
  shifts AS (SELECT *, abs(reference_mean - current_mean) / (abs(reference_mean) + 1e-9) * 100 AS shift_pct,
    abs(reference_mean - current_mean) > 0.1 * abs(reference_mean) AND abs(reference_mean - current_mean) > 1e-5 AS drifted FROM means)"""


@query("m3_drift_mean_shift", f"WITH {SHIFTS} -- result\n SELECT * FROM shifts", doubles="reference_mean current_mean shift_pct")
def m3(spark, folder):
    return D.mean_shift(*_halves(spark, folder))


KINDS = {"date": "timestamp_ntz", "tic": "string", "open": "double", "high": "double", "low": "double", "close": "double", "volume": "bigint"}


@query(
    "m4_drift_report",
    f"""WITH {SHIFTS}, parts AS (SELECT 'column_count' AS "check", '*' AS "column", '7' AS reference, '7' AS current, CAST(NULL AS DOUBLE) AS shift_pct, false AS drifted
      UNION ALL SELECT 'dtype', c, t, t, NULL, false FROM (VALUES {", ".join(f"('{c}', '{t}')" for c, t in KINDS.items())}) v(c, t)
      UNION ALL SELECT 'mean_shift', "column", printf('%.4f', reference_mean), printf('%.4f', current_mean), shift_pct, drifted FROM shifts)
    -- result
    SELECT * FROM parts UNION ALL SELECT 'overall', '*', NULL, NULL, NULL, bool_or(drifted) FROM parts""",
    doubles="shift_pct",
)
def m4(spark, folder):
    return D.drift_report(*_halves(spark, folder))


@query(
    "m5_drift_psi",
    f"""WITH {HALVES}, e AS (SELECT min(close) AS lo, max(close) AS hi FROM ref),
    r AS (SELECT least(CAST(floor((close - lo) / (hi - lo) * 10) AS BIGINT) + 1, 10) AS bin, count(*) AS n FROM ref, e GROUP BY 1),
    c AS (SELECT greatest(least(CAST(floor((close - lo) / (hi - lo) * 10) AS BIGINT) + 1, 10), 1) AS bin, count(*) AS n FROM cur, e GROUP BY 1),
    b AS (SELECT coalesce(r.bin, c.bin) AS bin, coalesce(r.n, 0) AS reference, coalesce(c.n, 0) AS current,
      greatest(coalesce(r.n, 0) / (SELECT sum(n) FROM r), 1e-6) AS p, greatest(coalesce(c.n, 0) / (SELECT sum(n) FROM c), 1e-6) AS q FROM r FULL JOIN c ON r.bin = c.bin)
    -- result
    SELECT bin, reference, current, (q - p) * ln(q / p) AS psi_part FROM b""",
    doubles="psi_part",
)
def m5_psi(spark, folder):
    return D.stability_index(*_halves(spark, folder), "close")


@query(
    "m5_drift_ks",
    f"""WITH {HALVES}, a AS (SELECT close AS v, 1 AS r, 0 AS c FROM ref UNION ALL SELECT close, 0, 1 FROM cur),
    g AS (SELECT v, sum(r) AS r, sum(c) AS c FROM a GROUP BY v), f AS (SELECT sum(r) OVER w / (SELECT count(*) FROM ref) AS fr, sum(c) OVER w / (SELECT count(*) FROM cur) AS fc FROM g WINDOW w AS (ORDER BY v)),
    a2 AS (SELECT volume AS v, 1 AS r, 0 AS c FROM ref UNION ALL SELECT volume, 0, 1 FROM cur),
    g2 AS (SELECT v, sum(r) AS r, sum(c) AS c FROM a2 GROUP BY v), f2 AS (SELECT sum(r) OVER w / (SELECT count(*) FROM ref) AS fr, sum(c) OVER w / (SELECT count(*) FROM cur) AS fc FROM g2 WINDOW w AS (ORDER BY v))
    -- result
    SELECT 'close' AS "column", max(abs(fr - fc)) AS ks FROM f UNION ALL SELECT 'volume', max(abs(fr - fc)) FROM f2""",
    doubles="ks",
)
def m5_ks(spark, folder):
    return D.ks_statistic(*_halves(spark, folder), ["close", "volume"])


@query(
    "m5_drift_chi_square",
    """WITH ref AS (SELECT o_orderpriority AS v FROM orders WHERE o_orderstatus = 'F'), cur AS (SELECT o_orderpriority AS v FROM orders WHERE o_orderstatus <> 'F'),
    r AS (SELECT v, count(*) AS r FROM ref GROUP BY 1), c AS (SELECT v, count(*) AS c FROM cur GROUP BY 1),
    b AS (SELECT coalesce(r, 0) AS r, coalesce(c, 0) AS c, coalesce(r, 0) / (SELECT count(*) FROM ref) * (SELECT count(*) FROM cur) AS e FROM r FULL JOIN c ON r.v = c.v)
    -- result
    SELECT 'o_orderpriority' AS "column", sum(CASE WHEN r > 0 THEN (c - e) ** 2 / e END) AS chi_square, count(*) FILTER (r > 0) AS categories, count(*) FILTER (r = 0) AS new_categories FROM b""",
    doubles="chi_square",
)
def m5_chi(spark, folder):
    orders = I.table(spark, folder, "orders")
    return D.chi_square(
        orders.filter("o_orderstatus = 'F'"), orders.filter("o_orderstatus <> 'F'"), ["o_orderpriority"]
    )


@query(
    "m6_prediction_distribution",
    """WITH b AS (SELECT last_day(ts) AS month, least(CAST(floor((value - (SELECT min(value) FROM events)) / ((SELECT max(value) FROM events) - (SELECT min(value) FROM events)) * 10) AS BIGINT) + 1, 10) AS bin FROM events)
    -- result
    SELECT month, bin, count(*) AS n FROM b GROUP BY 1, 2""",
    dates="month",
)
def m6(spark, folder):
    return P.histogram(I.ticks(spark, folder), "value", 10, by=[F.last_day("ts").alias("month")])


@query(
    "m7_model_degradation",
    f"""WITH {S.NEWS}, {S.CLEANED}, {S.LABELLED},
    p AS (SELECT quality AS truth, CASE WHEN label = 'negative' THEN 0 ELSE 1 END AS pred FROM labels JOIN labelled ON id = doc_id),
    k AS (SELECT c AS class, count(*) FILTER (truth = c) AS actual, count(*) FILTER (pred = c) AS claimed, count(*) FILTER (truth = c AND pred = c) AS hit FROM p, (VALUES (0), (1)) v(c) GROUP BY 1)
    -- result
    SELECT class, actual, claimed, hit, hit / claimed AS precision, hit / actual AS recall, 2 * hit / (claimed + actual) AS f1,
      (SELECT avg(CAST(truth = pred AS DOUBLE)) FROM p) AS accuracy, (SELECT avg(CAST(truth = pred AS DOUBLE)) FROM p) < 0.7 AS alert FROM k""",
    doubles="precision recall f1 accuracy",
)
def m7(spark, folder):
    predicted = I.labelled_news(spark, folder).select(
        F.col("id").alias("doc_id"), F.when(F.col("label") == "negative", 0).otherwise(1).alias("pred")
    )
    both = I.table(spark, folder, "labels").join(predicted, "doc_id")
    return D.label_quality(both, "quality", "pred")


@query(
    "m8_stored_metrics",
    """-- result
    SELECT event_type AS run, 'k' || user_id % 7 AS key, arg_max(value, event_id) AS value, max(event_id) AS step FROM events GROUP BY 1, 2""",
    doubles="value",
)
def m8(spark, folder):
    metrics = I.table(spark, folder, "events").select(
        F.col("event_type").alias("run"), F.concat(F.lit("k"), F.pmod("user_id", F.lit(7))).alias("key"), "value",
        F.col("event_id").alias("step"),
    )
    return D.latest_metrics(metrics)


@query(
    "m8_appended_metrics",
    """WITH m AS (SELECT event_type AS run, 'k' || user_id % 7 AS key, event_id AS step, value FROM events),
    a AS (SELECT run, key, step, CASE WHEN run = 'error' AND step % 3 = 0 THEN value + 1 ELSE value END AS value FROM m) -- result
    SELECT run, key, count(*) AS steps, max(step) AS step, arg_max(value, step) AS value FROM a GROUP BY 1, 2""",
    doubles="value",
)
def m8_appended(spark, folder):
    """Every run is appended, two of them twice, and the run of errors has a second attempt at every third step."""
    path = scratch_path(spark, "metrics")
    events = I.table(spark, folder, "events").select(
        "event_type", F.concat(F.lit("k"), F.pmod("user_id", F.lit(7))).alias("key"), "value", F.col("event_id").alias("step"))
    for run in (*I.TICKERS, "view", "error"):
        D.append_metrics(events.where(F.col("event_type") == run), path, run)
    again = events.where("event_type = 'error' and step % 3 = 0").withColumn("value", F.col("value") + 1)
    D.append_metrics(again, path, "error", attempt=1)
    steps = D.stored_metrics(spark, path)
    latest = D.latest_metrics(steps)
    return latest.join(steps.groupBy("run", "key").agg(F.count("*").alias("steps")), ["run", "key"])


@query(
    "m8_metric_history",
    """WITH m AS (SELECT event_type AS run, event_id AS step, value AS eval_loss, value / 100 AS eval_accuracy FROM events)
    -- result
    SELECT run, 'eval_loss' AS key, eval_loss AS value, step FROM m UNION ALL SELECT run, 'eval_accuracy', eval_accuracy, step FROM m""",
    doubles="value",
)
def m8_history(spark, folder):
    entry = F.struct(F.col("event_id").alias("step"), F.col("value").alias("eval_loss"), (F.col("value") / 100).alias("eval_accuracy"))
    states = I.table(spark, folder, "events").select(
        F.col("event_type").alias("run"), F.to_json(F.struct(F.array(entry).alias("log_history"))).alias("state")
    )
    return D.metric_history(states)
