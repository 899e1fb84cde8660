"""Queries: bars, technical indicators and other window steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.catalog import sql as S
from tickloom.catalog.registry import query
from tickloom.operators import bars as B
from tickloom.operators import indicators as N
from tickloom.operators import returns as R
from tickloom.operators import turbulence as TB
from tickloom.operators.series import HOURLY
from tickloom.plans import inputs as I
from tickloom.session import cut

W = "WINDOW w AS (PARTITION BY tic ORDER BY date)"


def hourly(spark, folder, *names):
    return N.indicator_pack(cut(I.bars_hourly(spark, folder), "bars"), names, HOURLY)


def long_closes(spark, folder):
    """Daily closes per brand, written once: the series steps read them more than once."""
    return cut(I.bars_long(spark, folder).select("date", "tic", "close"), "bars")


def pick(df, *cols):
    return df.select("date", "tic", *cols)


@query("a20_bars_from_ticks", f"WITH {S.BARS_HOURLY} -- result\n SELECT * FROM bars", doubles=S.OHLC, dates="date")
def a20(spark, folder):
    return I.bars_hourly(spark, folder)


@query("a20_bars_daily_long", f"WITH {S.BARS_LONG} -- result\n SELECT * FROM bars", doubles=f"{S.OHLC} volume",
       dates="date", digits=9)
def a20_long(spark, folder):
    return I.bars_long(spark, folder)


def _mean(n: int) -> str:
    return (f"CASE WHEN row_number() OVER w >= {n} THEN avg(close) OVER (PARTITION BY tic ORDER BY date "
            f"ROWS {n - 1} PRECEDING) END")


@query(
    "w1_sma",
    f"""WITH {S.BARS_HOURLY}
    -- result
    SELECT date, tic, {_mean(10)} AS sma_10, {_mean(20)} AS sma_20, {_mean(50)} AS sma_50 FROM bars {W}""",
    doubles="sma_10 sma_20 sma_50",
    dates="date",
)
def w1(spark, folder):
    return pick(hourly(spark, folder, "sma_10", "sma_20", "sma_50"), "sma_10", "sma_20", "sma_50")


@query(
    "w2_ema",
    f"""WITH RECURSIVE {S.BARS_HOURLY}, {S.smoothed()}
    -- result
    SELECT date, tic, CASE WHEN rn >= 12 THEN e12 END AS ema_12, CASE WHEN rn >= 20 THEN e20 END AS ema_20,
      CASE WHEN rn >= 50 THEN e50 END AS ema_50 FROM r""",
    doubles="ema_12 ema_20 ema_50",
    dates="date",
)
def w2(spark, folder):
    return pick(hourly(spark, folder, "ema_12", "ema_20", "ema_50"), "ema_12", "ema_20", "ema_50")


RSI = "CASE WHEN rn >= 14 THEN CASE WHEN l14 = 0 THEN 100.0 ELSE 100 - 100 / (1 + g14 / l14) END END"


@query(
    "w3_rsi",
    f"""WITH RECURSIVE {S.BARS_HOURLY}, {S.smoothed()}
    -- result
    SELECT date, tic, {RSI} AS rsi FROM r""",
    doubles="rsi",
    dates="date",
)
def w3(spark, folder):
    return pick(hourly(spark, folder, "rsi"), "rsi")


MACD = """CASE WHEN rn >= 26 THEN e12 - e26 END AS macd, CASE WHEN rn >= 34 THEN sig END AS macd_signal,
      CASE WHEN rn >= 34 THEN e12 - e26 - sig END AS macd_diff"""


@query(
    "w4_macd",
    f"""WITH RECURSIVE {S.BARS_HOURLY}, {S.smoothed()}
    -- result
    SELECT date, tic, {MACD} FROM r""",
    doubles="macd macd_signal macd_diff",
    dates="date",
)
def w4(spark, folder):
    return pick(hourly(spark, folder, "macd"), "macd", "macd_signal", "macd_diff")


@query(
    "w5_indicator_pack",
    f"""WITH RECURSIVE {S.BARS_HOURLY}, {S.smoothed()}, m AS (SELECT date, tic, {_mean(20)} AS close_20_sma,
      {_mean(50)} AS close_50_sma, open, high, low, close, volume FROM bars {W})
    -- result
    SELECT m.*, {MACD}, {RSI} AS rsi_14, CASE WHEN rn >= 20 THEN e20 END AS ema_20
      FROM m JOIN r ON m.tic = r.tic AND m.date = r.date""",
    doubles=f"{S.OHLC} macd macd_signal macd_diff rsi_14 close_20_sma close_50_sma ema_20",
    dates="date",
)
def w5(spark, folder):
    return hourly(spark, folder, *N.DEFAULT_PACK)


@query(
    "w6_indicators_per_ticker",
    f"""WITH RECURSIVE {S.BARS_DAILY}, {S.smoothed()}, m AS (SELECT date, tic, {_mean(20)} AS sma_20,
      {_mean(50)} AS sma_50, close FROM bars {W})
    -- result
    SELECT m.*, CASE WHEN rn >= 20 THEN e20 END AS ema_20, CASE WHEN rn >= 50 THEN e50 END AS ema_50, {RSI} AS rsi, {MACD},
      CAST(NULL AS DOUBLE) AS vix, CAST(NULL AS DOUBLE) AS turbulence
      FROM m JOIN r ON m.tic = r.tic AND m.date = r.date""",
    doubles="close sma_20 sma_50 ema_20 ema_50 rsi macd macd_signal macd_diff",
    dates="date",
)
def w6(spark, folder):
    """The standard set per ticker; 30 daily rows are too few for the 50-row columns, which stay NULL."""
    return N.technical_indicators(I.bars_daily(spark, folder)).drop("open", "high", "low", "volume")


@query(
    "w7_cci",
    f"""WITH {S.BARS_HOURLY}, t AS (SELECT date, tic, row_number() OVER w AS rn, (high + low + close) / 3.0 AS tp FROM bars {W}),
    c AS (SELECT a.date, a.tic, a.rn, a.tp, b.tp AS past, avg(b.tp) OVER (PARTITION BY a.tic, a.rn) AS mean
      FROM t a JOIN t b ON a.tic = b.tic AND b.rn BETWEEN a.rn - 19 AND a.rn)
    -- result
    SELECT date, tic, CASE WHEN rn >= 20 AND avg(abs(past - mean)) > 0 THEN (tp - any_value(mean)) / (0.015 * avg(abs(past - mean))) END AS cci_20
      FROM c GROUP BY date, tic, rn, tp""",
    doubles="cci_20",
    dates="date",
)
def w7(spark, folder):
    return pick(hourly(spark, folder, "cci_20"), "cci_20")


@query(
    "w8_dx",
    f"""WITH RECURSIVE {S.BARS_HOURLY}, d AS (SELECT *, row_number() OVER w AS rn, high - lag(high) OVER w AS up,
      lag(low) OVER w - low AS down, greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) AS tr FROM bars {W}),
    s AS MATERIALIZED (SELECT tic, date, rn, CASE WHEN up > down AND up > 0 THEN up ELSE 0.0 END AS p,
      CASE WHEN down > up AND down > 0 THEN down ELSE 0.0 END AS m, tr FROM d),
    r AS (SELECT tic, date, rn, CAST(p AS DOUBLE) AS p, CAST(m AS DOUBLE) AS m, CAST(tr AS DOUBLE) AS tr FROM s WHERE rn = 1
      UNION ALL SELECT s.tic, s.date, s.rn, r.p * (29.0/30) + s.p / 30, r.m * (29.0/30) + s.m / 30, r.tr * (29.0/30) + s.tr / 30
      FROM r JOIN s ON s.tic = r.tic AND s.rn = r.rn + 1)
    -- result
    SELECT date, tic, CASE WHEN rn >= 30 AND p + m > 0 THEN 100 * abs(100 * p / tr - 100 * m / tr) / (100 * p / tr + 100 * m / tr) END AS dx_30 FROM r""",
    doubles="dx_30",
    dates="date",
)
def w8(spark, folder):
    return pick(hourly(spark, folder, "dx_30"), "dx_30")


@query(
    "w9_bollinger",
    f"""WITH {S.BARS_HOURLY}, m AS (SELECT date, tic, row_number() OVER w AS rn, avg(close) OVER v AS mid, stddev_pop(close) OVER v AS sd
      FROM bars WINDOW w AS (PARTITION BY tic ORDER BY date), v AS (PARTITION BY tic ORDER BY date ROWS 19 PRECEDING))
    -- result
    SELECT date, tic, CASE WHEN rn >= 20 THEN mid END AS boll_mid, CASE WHEN rn >= 20 THEN mid + 2 * sd END AS boll_upper,
      CASE WHEN rn >= 20 THEN mid - 2 * sd END AS boll_lower FROM m""",
    doubles="boll_mid boll_upper boll_lower",
    dates="date",
)
def w9(spark, folder):
    return pick(hourly(spark, folder, "boll"), "boll_mid", "boll_upper", "boll_lower")


@query(
    "w10_lag_features",
    f"""WITH {S.BARS_HOURLY}
    -- result
    SELECT date, tic, lag(close, 1) OVER w AS close_lag1, lag(close, 5) OVER w AS close_lag5 FROM bars {W}""",
    doubles="close_lag1 close_lag5",
    dates="date",
)
def w10(spark, folder):
    return pick(hourly(spark, folder, "close_lag1", "close_lag5"), "close_lag1", "close_lag5")


@query(
    "w10_rolling_mean_feature",
    f"""WITH {S.BARS_HOURLY}
    -- result
    SELECT date, tic, avg(close) OVER (PARTITION BY tic ORDER BY date ROWS 2 PRECEDING) AS close_ma3 FROM bars""",
    doubles="close_ma3",
    dates="date",
)
def w10_mean(spark, folder):
    return pick(hourly(spark, folder, "close_ma3"), "close_ma3")


@query(
    "w11_daily_return",
    f"""WITH {S.BARS_LONG}
    -- result
    SELECT date, tic, close / lag(close) OVER w - 1 AS ret FROM bars {W}""",
    doubles="ret",
    dates="date",
)
def w11(spark, folder):
    return pick(R.daily_returns(long_closes(spark, folder), "close"), "ret")


@query(
    "w12_drawdown",
    f"""WITH {S.BARS_LONG}
    -- result
    SELECT date, tic, max(close) OVER w AS peak, close / max(close) OVER w - 1 AS drawdown FROM bars {W}""",
    doubles="peak drawdown",
    dates="date",
    digits=8,
)
def w12(spark, folder):
    return pick(R.drawdown(long_closes(spark, folder), "close"), "peak", "drawdown")


@query(
    "w13_latest_or_target_row",
    f"""WITH {S.BARS_LONG}
    -- result
    SELECT *, date <> DATE '2001-10-30' AS stale FROM bars
      QUALIFY row_number() OVER (PARTITION BY tic ORDER BY (date = DATE '2001-10-30') DESC, date DESC) = 1""",
    doubles=f"{S.OHLC} volume",
    dates="date",
    digits=9,
)
def w13(spark, folder):
    return B.latest_or_target(I.bars_long(spark, folder), F.lit("2001-10-30").cast("date"))


@query("w14_turbulence")
def w14(spark, folder):
    return TB.turbulence(long_closes(spark, folder))


BASKETS = f"""{S.BARS_LONG}, r AS (SELECT date, tic, close / lag(close) OVER {"(PARTITION BY tic ORDER BY date)"} - 1 AS ret FROM bars),
    b AS (SELECT date, CAST(substr(tic, 7, 1) AS INTEGER) % 3 AS basket, avg(ret) AS ret FROM r WHERE ret IS NOT NULL GROUP BY 1, 2),
    x AS (SELECT date, max(ret) FILTER (basket = 0) AS x, max(ret) FILTER (basket = 1) AS y, max(ret) FILTER (basket = 2) AS z FROM b GROUP BY date HAVING count(*) = 3),
    m AS (SELECT date, row_number() OVER o - 1 AS session, x - avg(x) OVER v AS u, y - avg(y) OVER v AS v, z - avg(z) OVER v AS w, var_samp(x) OVER v AS a,
      var_samp(y) OVER v AS b, var_samp(z) OVER v AS c, covar_samp(x, y) OVER v AS d, covar_samp(x, z) OVER v AS e, covar_samp(y, z) OVER v AS f
      FROM x WINDOW o AS (ORDER BY date), v AS (ORDER BY date ROWS BETWEEN 252 PRECEDING AND 1 PRECEDING)),
    turb AS (SELECT date, CASE WHEN session > 252 THEN ((b * c - f * f) * u * u + (a * c - e * e) * v * v + (a * b - d * d) * w * w
      + 2 * (e * f - c * d) * u * v + 2 * (d * f - b * e) * u * w + 2 * (d * e - a * f) * v * w)
      / (a * (b * c - f * f) - d * (d * c - e * f) + e * (d * f - b * e)) ELSE 0.0 END AS turbulence FROM m)"""


def basket_turbulence(bars):
    """Turbulence of three baskets of brands, with their full covariance."""
    basket = (F.substring("tic", 7, 1).cast("int") % 3).cast("string")
    return TB.turbulence_of_returns(TB.basket_returns(bars.select("date", "tic", "close"), basket))


@query("w14_turbulence_baskets", f"WITH {BASKETS} -- result\n SELECT * FROM turb", doubles="turbulence", dates="date", digits=4)
def w14_baskets(spark, folder):
    return basket_turbulence(long_closes(spark, folder))


@query(
    "w15_turbulence_diag",
    f"""WITH {S.BARS_LONG}, r AS (SELECT date, tic, close / lag(close) OVER w - 1 AS ret FROM bars {W}),
    z AS (SELECT *, avg(ret) OVER v AS mean, var_samp(ret) OVER v AS var, count(ret) OVER v AS n FROM r
      WINDOW v AS (PARTITION BY tic ORDER BY date ROWS BETWEEN 252 PRECEDING AND 1 PRECEDING))
    -- result
    SELECT date, coalesce(sum(CASE WHEN n >= 252 AND var > 0 THEN (ret - mean) ** 2 / var END), 0.0) AS turbulence FROM z GROUP BY date""",
    doubles="turbulence",
    dates="date",
)
def w15(spark, folder):
    return TB.turbulence_diagonal(long_closes(spark, folder))


@query(
    "w16_risk_gate",
    f"""WITH {S.BARS_LONG}, r AS (SELECT date, tic, close / lag(close) OVER w - 1 AS ret FROM bars {W}),
    z AS (SELECT *, avg(ret) OVER v AS mean, var_samp(ret) OVER v AS var, count(ret) OVER v AS n FROM r
      WINDOW v AS (PARTITION BY tic ORDER BY date ROWS BETWEEN 252 PRECEDING AND 1 PRECEDING)),
    t AS (SELECT date, coalesce(sum(CASE WHEN n >= 252 AND var > 0 THEN (ret - mean) ** 2 / var END), 0.0) AS turbulence FROM z GROUP BY date)
    -- result
    SELECT date, turbulence, turbulence > 30 AS risk_off FROM t""",
    doubles="turbulence",
    dates="date",
)
def w16(spark, folder):
    return B.risk_gate(TB.turbulence_diagonal(long_closes(spark, folder)), threshold=30.0)


@query(
    "w17_forward_fill_clean",
    f"""WITH {S.BARS_HOURLY}, sessions AS (SELECT DISTINCT date FROM bars), firsts AS (SELECT tic, min(date) AS f FROM bars GROUP BY 1),
    g AS (SELECT tic, s.date FROM firsts JOIN sessions s ON s.date >= f)
    -- result
    SELECT g.tic, g.date, last_value(b.open IGNORE NULLS) OVER w AS open, last_value(b.high IGNORE NULLS) OVER w AS high,
      last_value(b.low IGNORE NULLS) OVER w AS low, last_value(b.close IGNORE NULLS) OVER w AS close,
      coalesce(b.volume, 0) AS volume, b.close IS NULL AS filled
      FROM g LEFT JOIN bars b ON b.tic = g.tic AND b.date = g.date WINDOW w AS (PARTITION BY g.tic ORDER BY g.date)""",
    doubles=S.OHLC,
    dates="date",
)
def w17(spark, folder):
    return B.forward_fill(cut(I.bars_hourly(spark, folder), "bars"), series=HOURLY, step="1 hour")


@query(
    "w18_lookback_tensor",
    f"""WITH {S.BARS_HOURLY}, n AS (SELECT *, row_number() OVER (PARTITION BY tic ORDER BY date) AS rn FROM bars)
    -- result
    SELECT a.date, a.tic, CAST(b.rn - a.rn + 9 AS INTEGER) AS step, b.close, CAST(b.volume AS DOUBLE) AS volume
      FROM n a JOIN n b ON a.tic = b.tic AND b.rn BETWEEN a.rn - 9 AND a.rn WHERE a.rn >= 10""",
    doubles="close volume",
    dates="date",
)
def w18(spark, folder):
    """The tensor, shown one step a row."""
    tensor = N.lookback_tensor(cut(I.bars_hourly(spark, folder), "bars"), ("close", "volume"), 10, HOURLY)
    steps = tensor.select("date", "tic", F.posexplode("lookback").alias("step", "point"))
    return steps.select("date", "tic", "step", F.col("point")[0].alias("close"), F.col("point")[1].alias("volume"))


@query(
    "j5_join_turbulence",
    f"""WITH {S.BARS_LONG}, r AS (SELECT date, tic, close / lag(close) OVER w - 1 AS ret FROM bars {W}),
    z AS (SELECT *, avg(ret) OVER v AS mean, var_samp(ret) OVER v AS var, count(ret) OVER v AS n FROM r
      WINDOW v AS (PARTITION BY tic ORDER BY date ROWS BETWEEN 252 PRECEDING AND 1 PRECEDING)),
    t AS (SELECT date, coalesce(sum(CASE WHEN n >= 252 AND var > 0 THEN (ret - mean) ** 2 / var END), 0.0) AS turbulence FROM z GROUP BY date),
    idx AS (SELECT CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) / 1000 AS level FROM orders GROUP BY 1)
    -- result
    SELECT b.date, b.tic, b.volume, level IS NOT NULL AS has_vix, t.turbulence FROM bars b JOIN t ON b.date = t.date LEFT JOIN idx ON b.date = idx.date""",
    doubles="turbulence",
    dates="date",
)
def j5(spark, folder):
    from tickloom.operators.features import join_market_index, join_turbulence

    bars = cut(I.bars_long(spark, folder), "bars")
    levels = I.table(spark, folder, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(
        (F.avg("o_totalprice") / 1000).alias("level")
    )
    with_index = join_market_index(bars.select("date", "tic", "volume"), levels)
    joined = join_turbulence(with_index, TB.turbulence_diagonal(bars))
    return joined.withColumn("has_vix", F.col("vix").isNotNull()).drop("vix")
