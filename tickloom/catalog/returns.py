"""Queries: returns, back-test statistics, portfolio value."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.catalog import sql as S
from tickloom.catalog.registry import query
from tickloom.operators import returns as R
from tickloom.plans import inputs as I
from tickloom.session import cut

RET = "ret AS (SELECT *, close / lag(close) OVER (PARTITION BY tic ORDER BY date) - 1 AS ret, close / max(close) OVER (PARTITION BY tic ORDER BY date) - 1 AS dd FROM bars)"
BASE = "base AS (SELECT date, ret AS base FROM ret WHERE tic = 'Brand#11')"
STATS = """stats AS (SELECT tic, count(ret) AS days, arg_max(close, date) / arg_min(close, date) - 1 AS cumulative_return,
  (arg_max(close, date) / arg_min(close, date)) ** (252.0 / count(ret)) - 1 AS annual_return, stddev_samp(ret) * sqrt(252) AS annual_volatility,
  avg(ret) / stddev_samp(ret) * sqrt(252) AS sharpe, avg(ret) / sqrt(avg(least(ret, 0) ** 2)) * sqrt(252) AS sortino, min(dd) AS max_drawdown,
  ((arg_max(close, date) / arg_min(close, date)) ** (252.0 / count(ret)) - 1) / abs(min(dd)) AS calmar FROM ret GROUP BY tic)"""
STAT_COLUMNS = "cumulative_return annual_return annual_volatility sharpe sortino max_drawdown calmar"


def bars(spark, folder):
    return cut(I.bars_long(spark, folder).select("date", "tic", "open", "close", "volume"), "bars")


@query("p1_perf_stats", f"WITH {S.BARS_LONG}, {RET}, {STATS} -- result\n SELECT * FROM stats", doubles=STAT_COLUMNS)
def p1(spark, folder):
    return R.performance_stats(bars(spark, folder), "close")


def _returns(spark, folder):
    return R.daily_returns(bars(spark, folder), "close").select("date", "tic", "ret")


@query(
    "p2_win_loss_stats",
    f"""WITH {S.BARS_LONG}, {RET} -- result
    SELECT tic, count(*) FILTER (ret > 0) AS wins, count(*) FILTER (ret < 0) AS losses, count(*) FILTER (ret > 0) / count(ret) AS win_rate,
      avg(ret) FILTER (ret > 0) / abs(avg(ret) FILTER (ret < 0)) AS win_loss_ratio, avg(ret) FILTER (ret > 0) AS mean_win,
      avg(ret) FILTER (ret < 0) AS mean_loss, sum(ret) FILTER (ret > 0) / abs(sum(ret) FILTER (ret < 0)) AS profit_factor FROM ret GROUP BY tic""",
    doubles="win_rate win_loss_ratio mean_win mean_loss profit_factor",
)
def p2(spark, folder):
    return R.win_loss_stats(_returns(spark, folder))


@query(
    "p3_omega",
    f"""WITH {S.BARS_LONG}, {RET} -- result
    SELECT tic, sum(greatest(ret - 0.01, 0)) / sum(greatest(0.01 - ret, 0)) AS omega FROM ret WHERE ret IS NOT NULL GROUP BY tic""",
    doubles="omega",
)
def p3(spark, folder):
    return R.omega(_returns(spark, folder), 0.01)


@query(
    "p3_turnover",
    f"""WITH {S.BARS_LONG}, wt AS (SELECT date, tic, close * volume / sum(close * volume) OVER (PARTITION BY date) AS weight FROM bars),
    ch AS (SELECT date, abs(weight - coalesce(lag(weight) OVER (PARTITION BY tic ORDER BY date), 0)) AS c FROM wt)
    -- result
    SELECT date, sum(c) / 2 AS turnover FROM ch GROUP BY date""",
    doubles="turnover", dates="date",
)
def p3_turnover(spark, folder):
    return R.turnover(R.portfolio_weights(bars(spark, folder)))


def _base(returns):
    return returns.filter("tic = 'Brand#11'")


@query(
    "p4_baseline_compare",
    f"""WITH {S.BARS_LONG}, {RET}, {BASE}, j AS (SELECT * FROM ret JOIN base ON ret.date = base.date WHERE ret.ret IS NOT NULL AND base IS NOT NULL)
    -- result
    SELECT tic, count(*) AS days, avg(ret - base) AS mean_excess, regr_slope(ret, base) AS beta, corr(ret, base) AS correlation FROM j GROUP BY tic""",
    doubles="mean_excess beta correlation",
)
def p4(spark, folder):
    returns = _returns(spark, folder)
    return R.baseline_compare(returns, _base(returns))


@query(
    "j9_baseline_join",
    f"""WITH {S.BARS_LONG}, {RET}, {BASE} -- result
    SELECT ret.date, tic, ret, base AS baseline_ret FROM ret JOIN base ON ret.date = base.date""",
    doubles="ret baseline_ret", dates="date",
)
def j9(spark, folder):
    returns = _returns(spark, folder)
    return R.join_baseline(returns, _base(returns))


@query("p5_sharpe_alert", f"WITH {S.BARS_LONG}, {RET}, {STATS} -- result\n SELECT tic, sharpe FROM stats WHERE sharpe < 6.0", doubles="sharpe")
def p5(spark, folder):
    return R.sharpe_alert(R.performance_stats(bars(spark, folder), "close"), 6.0).select("tic", "sharpe")


@query(
    "p6_bootstrap_returns",
    f"""WITH {S.BARS_LONG}, {RET}, n AS (SELECT tic, ret, row_number() OVER (PARTITION BY tic ORDER BY date) - 1 AS rn FROM ret WHERE ret IS NOT NULL),
    c AS (SELECT tic, count(*) AS n FROM n GROUP BY 1),
    d AS (SELECT tic, p AS path, ('0x' || substr(md5('7:' || tic || ':' || p || ':' || t), 1, 8))::BIGINT % n AS rn FROM c, range(100) a(p), range(60) b(t))
    -- result
    SELECT tic, CAST(path AS INTEGER) AS path, sum(ln(1 + ret)) AS log_return, count(*) AS draws FROM d JOIN n USING (tic, rn) GROUP BY 1, 2""",
    doubles="log_return",
)
def p6(spark, folder):
    return R.bootstrap_paths(_returns(spark, folder), paths=100, days=60, seed=7)


@query(
    "p7_signal_portfolio_value",
    f"""WITH {S.BARS_LONG}, a AS (SELECT date, tic, coalesce(lag(CASE WHEN close > open THEN 1.0 ELSE 0.0 END) OVER w, 0.0) AS position,
      coalesce(close / lag(close) OVER w - 1, 0.0) AS r FROM bars WINDOW w AS (PARTITION BY tic ORDER BY date)),
    b AS (SELECT date, tic, position, position * r - 0.001 * abs(position - coalesce(lag(position) OVER w, 0.0)) AS net_return FROM a WINDOW w AS (PARTITION BY tic ORDER BY date))
    -- result
    SELECT date, tic, position, net_return, CASE WHEN min(1 + net_return) OVER w > 0 THEN ln(1000000.0) + sum(CASE WHEN net_return > -1 THEN ln(1 + net_return) ELSE 0 END) OVER w END AS log_value
      FROM b WINDOW w AS (PARTITION BY tic ORDER BY date)""",
    doubles="position net_return log_value", dates="date",
)
def p7(spark, folder):
    """Hold a ticker on the day after it closed above its open."""
    signal = F.when(F.col("close") > F.col("open"), 1.0).otherwise(0.0)
    value = R.signal_portfolio(bars(spark, folder), signal)
    return value.select("date", "tic", F.col("position").cast("double"), "net_return", F.log(F.nullif("account_value", F.lit(0.0))).alias("log_value"))
