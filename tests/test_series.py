"""Series steps against pandas, with blocks small enough that every series spans several."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators import indicators as N
from tickloom.operators import returns as R
from tickloom.operators import series as S
from tickloom.operators import turbulence as T
from tickloom.operators.bars import forward_fill, latest_or_target


def walk(tickers, days, seed=0, gaps=0.0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(tickers):
        close = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, days)))
        for j in range(days):
            if rng.random() >= gaps:
                d = dt.date(2015, 1, 1) + dt.timedelta(days=j)
                c = float(close[j])
                rows.append((d, f"T{i}", c * 0.99, c * 1.02, c * 0.97, c, 100.0 + j))
    return pd.DataFrame(rows, columns="date tic open high low close volume".split())


@pytest.fixture(scope="module")
def bars_pdf():
    return walk(3, 1500, gaps=0.1)


@pytest.fixture(scope="module")
def bars(spark, bars_pdf):
    return spark.createDataFrame(bars_pdf).cache()


@pytest.fixture(params=[4096, 150])
def small_blocks(request, monkeypatch):
    whole = S.blocks
    monkeypatch.setattr(N, "blocks", lambda df, series, history, rows=None: whole(df, series, history, request.param))
    monkeypatch.setattr(T, "blocks", lambda df, series, history: whole(df, series, history, request.param))
    monkeypatch.setattr(S, "BUCKET_ROWS", 1000)
    return request.param


def ordered(df):
    pdf = df.toPandas()
    return pdf.sort_values(["tic", "date"]).reset_index(drop=True)


def expected(pdf):
    out = []
    for _, g in pdf.groupby("tic"):
        g = g.sort_values("date").copy()
        c = g["close"]
        for n in (20, 100):
            g[f"sma_{n}"] = c.rolling(n).mean()
        for n in (2, 3, 20, 200):
            g[f"ema_{n}"] = c.ewm(span=n, min_periods=n, adjust=False).mean()
        d = c.diff()
        up = d.where(d > 0, 0.0).ewm(alpha=1 / 14, min_periods=14, adjust=False).mean()
        down = (-d.where(d < 0, 0.0)).ewm(alpha=1 / 14, min_periods=14, adjust=False).mean()
        g["rsi"] = 100 - 100 / (1 + up / down)
        g["macd"] = (
            c.ewm(span=12, min_periods=26, adjust=False).mean() - c.ewm(span=26, min_periods=26, adjust=False).mean()
        )
        g["macd_signal"] = g["macd"].ewm(span=9, min_periods=9, adjust=False).mean()
        g["macd_diff"] = g["macd"] - g["macd_signal"]
        out.append(g)
    return pd.concat(out).sort_values(["tic", "date"]).reset_index(drop=True)


def test_indicators_equal_pandas(spark, bars, bars_pdf, small_blocks):
    names = ["sma_20", "sma_100", "ema_2", "ema_3", "ema_20", "ema_200", "rsi", "macd"]
    got, want = ordered(N.indicator_pack(bars, names)), expected(bars_pdf)
    assert len(got) == len(want)
    for c in [c for c in want.columns if c not in ("date", "tic")]:
        a, b = got[c].astype(float), want[c].astype(float)
        assert (a.isna() == b.isna()).all(), c
        assert np.nanmax(np.abs(a - b)) < 1e-8, c


@pytest.mark.parametrize("moving, flat", [(1000, 8000), (3000, 3000)])
def test_standstill_keeps_rsi_and_dx(spark, moving, flat):
    """Means that decay through a long standstill, against the plain recursion; the caller's own columns stay."""
    rng = np.random.default_rng(6)
    close = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, moving)))
    close = np.concatenate([close, np.full(flat, close[-1])])
    spread = np.concatenate([rng.uniform(0.1, 2, moving), np.zeros(flat)])
    pdf = pd.DataFrame({"date": pd.date_range("2020-01-01", periods=moving + flat, freq="h"), "tic": "A", "high": close + spread,
                        "low": close - spread, "close": close, "_note": 1})
    got = ordered(N.indicator_pack(spark.createDataFrame(pdf), ["rsi_14", "dx_30"], S.HOURLY))
    change = np.diff(close, prepend=close[0])
    up, down = np.diff(pdf.high, prepend=np.nan), -np.diff(pdf.low, prepend=np.nan)
    inputs = [np.maximum(change, 0), np.maximum(-change, 0), np.where((up > down) & (up > 0), up, 0), np.where((down > up) & (down > 0), down, 0)]
    means = []
    for x, n in zip(inputs, (14, 14, 30, 30), strict=True):
        value, out = x[0], []
        for v in x:
            value += (v - value) / n
            out.append(value)
        means.append(np.array(out))
    gain, loss, plus, minus = means
    with np.errstate(all="ignore"):
        assert np.allclose(got["rsi_14"][13:], (100 - 100 / (1 + gain / loss))[13:], rtol=0, atol=1e-8)
        assert np.allclose(got["dx_30"][29:], (100 * abs(plus - minus) / (plus + minus))[29:], rtol=0, atol=1e-8)
    assert got["_note"].eq(1).all()


def test_short_series_stays_null(spark, bars_pdf):
    short = spark.createDataFrame(bars_pdf[bars_pdf.tic == "T0"].head(10))
    row = ordered(N.technical_indicators(short))
    assert row[["sma_20", "ema_20", "rsi", "macd"]].isna().all().all() and "vix" in row and "turbulence" in row


def test_constant_series(spark):
    days = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), "A", 5.0) for i in range(60)]
    got = ordered(N.indicator_pack(spark.createDataFrame(days, "date date, tic string, close double"), ["sma_20", "ema_20", "macd", "rsi"]))
    assert got["sma_20"].dropna().eq(5.0).all() and np.allclose(got["ema_20"].dropna(), 5.0)
    assert np.allclose(got["macd"].dropna(), 0.0) and got["rsi"].dropna().eq(100.0).all()


def test_independent_of_partitioning(spark, bars):
    one, many = bars.coalesce(1), bars.repartition(17)
    a, b = (ordered(N.indicator_pack(d, ["macd", "rsi", "ema_20"])) for d in (one, many))
    pd.testing.assert_frame_equal(a, b, check_exact=False, rtol=1e-12)


def test_a_hot_series_is_many_groups(spark):
    """A ticker with most of the rows is cut into bounded blocks, each with enough history."""
    n = 12_000
    day = F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int"))
    hot = spark.range(n).select(day.alias("date"), F.lit("HOT").alias("tic"), F.col("id").cast("double").alias("close"))
    b = S.blocks(hot, S.DAILY, 300, block_rows=1000)
    sizes = b.df.groupBy("tic", "_block").agg(F.count("*").alias("n"), F.count_if("_own").alias("own"), F.min("_rn").alias("lo"),
                                               F.min(F.when(F.col("_own"), F.col("_rn"))).alias("first")).filter("own > 0").collect()
    assert len(sizes) >= 8 and max(r.n for r in sizes) <= 1000 + 300 + 2 * 366
    assert sum(r.own for r in sizes) == n
    assert all(r["first"] - r.lo >= 300 or r.lo == 0 for r in sizes)


def test_oversized_bucket_is_refused(spark):
    same_year = spark.range(1500).select(
        F.lit("A").alias("tic"), (F.lit("2020-01-01").cast("timestamp") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("date"),
        F.lit(1.0).alias("close"))
    with pytest.raises(Exception, match="holds over"):
        N.indicator_pack(same_year, ["sma_20"], S.DAILY).count()


def test_running_equals_pandas(spark, bars, bars_pdf):
    got = ordered(S.running(bars, S.DAILY, {
        "total": ("sum", "close"), "peak": ("max", "close"), "low_so_far": ("min", "close"), "prev": ("lag", "close")}))
    g = bars_pdf.sort_values(["tic", "date"]).reset_index(drop=True)
    by = g.groupby("tic")["close"]
    assert np.allclose(got["total"], by.cumsum()) and np.allclose(got["peak"], by.cummax())
    assert np.allclose(got["low_so_far"], by.cummin()) and np.allclose(got["prev"], by.shift(), equal_nan=True)


def test_forward_fill(spark):
    rows = [("2024-01-01", "A", 1.0), ("2024-01-03", "A", 3.0), ("2024-01-02", "B", 2.0), ("2024-01-05", "B", 5.0)]
    df = spark.createDataFrame(rows, "d string, tic string, close double").selectExpr(
        "cast(d as date) date", "tic", "close open", "close high", "close low", "close", "10.0 volume")
    got = [(str(r.date), r.tic, r.close, float(r.volume)) for r in forward_fill(df).orderBy("tic", "date").collect()]
    assert got == [
        ("2024-01-01", "A", 1.0, 10.0), ("2024-01-02", "A", 1.0, 0.0), ("2024-01-03", "A", 3.0, 10.0), ("2024-01-05", "A", 3.0, 0.0),
        ("2024-01-02", "B", 2.0, 10.0), ("2024-01-03", "B", 2.0, 0.0), ("2024-01-05", "B", 5.0, 10.0)]


def test_latest_or_target(spark):
    df = spark.createDataFrame([("A", "2024-01-01", 1.0), ("A", "2024-01-02", 2.0), ("B", "2024-01-01", 9.0), ("A", "2024-01-03", 3.0)],
                               "tic string, d string, close double").selectExpr("tic", "cast(d as date) date", "close")
    got = {r.tic: (r.close, r.stale) for r in latest_or_target(df, F.lit("2024-01-02").cast("date")).collect()}
    assert got == {"A": (2.0, False), "B": (9.0, True)}


def brute_turbulence(pdf, lookback):
    wide = pdf.pivot(index="date", columns="tic", values="close")
    ret = wide.apply(lambda c: c.dropna().pct_change().reindex(c.index))
    out = {}
    for i, day in enumerate(ret.index):
        past, today = ret.iloc[max(0, i - lookback):i], ret.iloc[i]
        held = [t for t in ret.columns if i > lookback and not past[t].isna().any() and not np.isnan(today[t])]
        if i <= lookback or not held:
            out[day] = 0.0
            continue
        x = past[held].to_numpy()
        diff = today[held].to_numpy() - x.mean(axis=0)
        out[day] = float(diff @ np.linalg.pinv(np.atleast_2d(np.cov(x, rowvar=False))) @ diff)
    return out


@pytest.mark.parametrize("tickers, lookback, per_task", [(5, 40, 2000), (30, 20, 2000), (5, 40, 2), (30, 20, 4)])
def test_turbulence_equals_brute_force(spark, tickers, lookback, per_task):
    pdf = walk(tickers, 150, seed=3)
    found = T.turbulence(spark.createDataFrame(pdf), lookback, block_sessions=17, tickers_per_task=per_task)
    got = {r.date: r.turbulence for r in found.collect()}
    want = brute_turbulence(pdf, lookback)
    assert got.keys() == want.keys()
    for d, v in want.items():
        assert got[d] == pytest.approx(v, rel=1e-6, abs=1e-8)


def test_turbulence_leaves_out_gaps(spark):
    pdf = walk(6, 120, seed=4)
    pdf = pdf[~((pdf.tic == "T2") & (pdf.date == pdf.date.max() - dt.timedelta(days=20)))]
    got = {r.date: r.turbulence for r in T.turbulence(spark.createDataFrame(pdf), 30).collect()}
    for d, v in brute_turbulence(pdf, 30).items():
        assert got[d] == pytest.approx(v, rel=1e-6, abs=1e-8)


def test_diagonal_turbulence(spark, small_blocks):
    pdf = walk(4, 400, seed=5)
    got = {r.date: r.turbulence for r in T.turbulence_diagonal(spark.createDataFrame(pdf), 100).collect()}
    wide = pdf.pivot(index="date", columns="tic", values="close").pct_change()
    mean, var = wide.rolling(100).mean().shift(), wide.rolling(100).var().shift()
    want = (((wide - mean) ** 2) / var).sum(axis=1, min_count=1).fillna(0.0)
    for d, v in want.items():
        assert got[d] == pytest.approx(v, rel=1e-7, abs=1e-9)


def test_performance_of_a_ramp(spark):
    days = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), "A", v) for i, v in enumerate([100.0, 110.0, 99.0, 120.0])]
    row = R.performance_stats(spark.createDataFrame(days, "date date, tic string, account_value double")).first()
    assert row.days == 3 and row.cumulative_return == pytest.approx(0.2) and row.max_drawdown == pytest.approx(-0.1)


def test_ruined_portfolio_stays_at_zero(spark):
    days = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), "A", v) for i, v in enumerate([100.0, 50.0, 200.0, 210.0])]
    df = spark.createDataFrame(days, "date date, tic string, close double")
    values = [r.account_value for r in R.signal_portfolio(df, F.lit(-1.0), cost=0.0).orderBy("date").collect()]
    assert values[1] > 0 and values[2:] == [0.0, 0.0]


def test_bootstrap_is_repeatable(spark):
    days = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), "A", 0.01 * ((i % 7) - 3)) for i in range(50)]
    df = spark.createDataFrame(days, "date date, tic string, ret double")
    runs = [sorted((r.path, round(r.log_return, 12), r.draws) for r in R.bootstrap_paths(d, 20, 30, seed=1).collect())
            for d in (df, df.repartition(7))]
    assert runs[0] == runs[1] and all(n == 30 for _, _, n in runs[0])


def test_averages_around_a_missing_value(spark):
    closes = [1.0, 2.0, None, 4.0, 5.0, 6.0]
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), "A", v) for i, v in enumerate(closes)]
    got = ordered(N.indicator_pack(spark.createDataFrame(rows, "date date, tic string, close double"), ["sma_3", "close_ma3"]))
    assert [None if np.isnan(v) else v for v in got["sma_3"]] == [None, None, None, None, None, 5.0]
    assert list(got["close_ma3"]) == [1.0, 1.5, 1.5, 3.0, 4.5, 5.0]
