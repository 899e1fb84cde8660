"""Turbulence of a market: how unusual a day's returns are against the 252 sessions before it."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.returns import daily_returns
from tickloom.operators.series import DAILY, Series, add_level, blocks, trailing_moments

LOOKBACK = 252


def turbulence_diagonal(bars: DataFrame, lookback: int = LOOKBACK, series: Series = DAILY) -> DataFrame:
    """Sum over tickers of the squared z-score of the day's return: the diagonal-covariance form.

    Needs no matrix, so it runs at any number of tickers: one block shuffle and one partial aggregate.
    Tickers count once they have a full look-back; 0 on days without any such ticker.
    """
    b = blocks(bars.select(*series.key, series.order, "close"), series, lookback + 2)
    add_level(b, {"ret": F.try_divide("close", F.lag("close").over(b.window)) - 1.0})
    past = trailing_moments(b, "ret", lookback, end=-1)
    z2 = F.try_divide(F.pow(F.col("ret") - past["mean"], 2), past["variance"])
    add_level(b, {"z2": F.when(past["count"] >= lookback, z2)})
    return b.finish().groupBy(series.order).agg(F.coalesce(F.sum("z2"), F.lit(0.0)).alias("turbulence"))


def _windows(block: pd.DataFrame, lookback: int) -> Iterator[tuple[int, np.ndarray | None, np.ndarray | None]]:
    """For each own session of a block its number, the centred look-back of the tickers without a gap
    (sessions x tickers), and their distance from the mean; None where there is nothing to measure."""
    days = np.arange(block["session"].min(), block["session"].max() + 1)
    tics, col = np.unique(block["tic"].to_numpy(), return_inverse=True)
    grid = np.full((len(days), len(tics)), np.nan)
    grid[block["session"].to_numpy() - days[0], col] = block["ret"].to_numpy()
    for session in np.unique(block.loc[block["own"], "session"].to_numpy()):
        at = session - days[0]
        centred = diff = None
        if at >= lookback and session > lookback:
            window, today = grid[at - lookback : at], grid[at]
            held = ~np.isnan(window).any(axis=0) & ~np.isnan(today)
            if held.any():
                mean = window[:, held].mean(axis=0)
                centred, diff = window[:, held] - mean, today[held] - mean
        yield int(session), centred, diff


def _spectrum(gram: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors of a Gram matrix without those that are zero up to rounding."""
    values, vectors = np.linalg.eigh(gram)
    kept = values > max(values[-1], 0.0) * size * np.finfo(float).eps
    return values[kept], vectors[:, kept]


def _distances(block: pd.DataFrame, lookback: int) -> pd.DataFrame:
    """diff . pinv(cov) . diff per session, through the smaller of the ticker and the session Gram matrix."""
    out = []
    for session, centred, diff in _windows(block, lookback):
        value = 0.0
        if centred is not None:
            size = max(centred.shape)
            if centred.shape[1] <= lookback:
                scale, basis = _spectrum(centred.T @ centred, size)
                value = np.sum((basis.T @ diff) ** 2 / scale)
            else:
                scale, basis = _spectrum(centred @ centred.T, size)
                value = np.sum((basis.T @ (centred @ diff) / scale) ** 2)
        out.append((session, float((lookback - 1) * value)))
    return pd.DataFrame(out, columns=["session", "turbulence"])


def _partial_grams(block: pd.DataFrame, lookback: int) -> pd.DataFrame:
    """A ticker group's part of the session Gram matrix and of the cross vector, which add up over groups."""
    out = []
    for session, centred, diff in _windows(block, lookback):
        if centred is not None:
            part = np.column_stack([centred @ centred.T, centred @ diff])
            out.append((session, centred.shape[1], part.tobytes()))
    return pd.DataFrame(out, columns=["session", "tickers", "part"])


def _added(parts: pd.DataFrame, lookback: int) -> np.ndarray:
    total = np.zeros((lookback, lookback + 1))
    for part in parts["part"]:
        total += np.frombuffer(part).reshape(total.shape)
    return total


def _add_parts(parts: pd.DataFrame, lookback: int) -> pd.DataFrame:
    total = _added(parts, lookback).tobytes()
    return pd.DataFrame({"session": [parts["session"].iloc[0]], "tickers": [parts["tickers"].sum()], "part": [total]})


def _distance_of_parts(parts: pd.DataFrame, lookback: int) -> pd.DataFrame:
    total = _added(parts, lookback)
    scale, basis = _spectrum(total[:, :lookback], max(lookback, int(parts["tickers"].sum())))
    value = (lookback - 1) * np.sum((basis.T @ total[:, lookback] / scale) ** 2)
    return pd.DataFrame({"session": [parts["session"].iloc[0]], "turbulence": [float(value)]})


def turbulence(
    bars: DataFrame, lookback: int = LOOKBACK, block_sessions: int = 63, tickers_per_task: int = 2000,
    series: Series = DAILY,
) -> DataFrame:
    """Mahalanobis distance of each day's return vector from the look-back window, with the full covariance.

    A pseudo-inverse has no SQL form, so blocks of sessions with their look-back go through Pandas functions.
    Up to `tickers_per_task` tickers, one block is one group: (block_sessions + lookback) rows a ticker,
    however long the history is. With more, tickers are hashed into groups of that size. The distance then
    follows from the (sessions x sessions) Gram matrix, to which every group adds its part, so no task sees
    all tickers. Tickers with a gap in the window are left out of that day.
    """
    returns = daily_returns(bars.select(*series.key, series.order, "close"), "close", series)
    return turbulence_of_returns(returns, lookback, block_sessions, tickers_per_task, series)


def basket_returns(bars: DataFrame, basket: Column, series: Series = DAILY) -> DataFrame:
    """(key, date, ret): mean return of each basket of tickers, on the days on which all baskets have one."""
    returns = daily_returns(bars.select(*bars.columns), "close", series).where("ret IS NOT NULL")
    means = returns.groupBy(basket.alias(series.key[0]), series.order).agg(F.avg("ret").alias("ret"))
    count = bars.agg(F.count_distinct(basket).alias("n")).scalar()
    full = means.groupBy(series.order).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == count)
    return means.join(full.select(series.order), series.order)


def turbulence_of_returns(
    returns: DataFrame, lookback: int = LOOKBACK, block_sessions: int = 63, tickers_per_task: int = 2000,
    series: Series = DAILY,
) -> DataFrame:
    """turbulence() of a table (key, date, ret), of tickers or of baskets of them."""
    key = series.key[0]
    # One row per session; numbering them is a window over the calendar only.
    sessions = (
        returns.select(series.order).distinct()
        .withColumn("session", F.row_number().over(Window.orderBy(series.order)).cast("long") - 1)
    )
    last = sessions.agg(F.floor(F.max("session") / block_sessions).alias("m")).scalar()
    home = F.floor(F.col("session") / block_sessions)
    until = F.least(F.floor((F.col("session") + lookback) / block_sessions), last)
    numbered = returns.join(sessions, series.order)
    spread = numbered.select(
        F.explode(F.sequence(home, F.greatest(home, until))).alias("block"),
        F.col(key).alias("tic"), "session", "ret", home.alias("home"),
    ).select("block", "tic", "session", "ret", (F.col("home") == F.col("block")).alias("own"))
    # Few bytes but much arithmetic: a stated partition count keeps the groups from being merged into few tasks.
    tasks = int(returns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = math.ceil(returns.select(key).distinct().count() / tickers_per_task)
    if groups <= 1:
        found = spread.repartition(tasks, "block").groupBy("block").applyInPandas(
            lambda pdf: _distances(pdf, lookback), "session long, turbulence double"
        )
    else:
        schema = "session long, tickers long, part binary"
        keyed = spread.withColumn("chunk", F.pmod(F.xxhash64("tic"), F.lit(groups)))
        parts = keyed.repartition(tasks, "block", "chunk").groupBy("block", "chunk").applyInPandas(
            lambda pdf: _partial_grams(pdf, lookback), schema
        )
        # Two levels of adding, so that a session's parts do not all meet in one group.
        branch = math.ceil(math.sqrt(groups))
        halfway = parts.withColumn("branch", F.pmod(F.xxhash64(F.col("part")), F.lit(branch)))
        added = halfway.groupBy("session", "branch").applyInPandas(lambda pdf: _add_parts(pdf, lookback), schema)
        found = added.groupBy("session").applyInPandas(
            lambda pdf: _distance_of_parts(pdf, lookback), "session long, turbulence double"
        )
    measured = F.coalesce("turbulence", F.lit(0.0)).alias("turbulence")
    return sessions.join(found, "session", "left").select(series.order, measured)
