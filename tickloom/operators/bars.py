"""OHLCV bars from ticks, and table-level steps on bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.series import DAILY, Series, running


def ohlcv(price: Column, order: Column, volume: Column) -> list[Column]:
    """Aggregates of one bar. Every one has a map-side part, so a hot ticker shuffles one row per task."""
    return [
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        volume.alias("volume"),
    ]


def bars_from_ticks(
    ticks: DataFrame,
    period: Column,
    price: str = "value",
    order: Column | None = None,
    volume: Column | None = None,
    key: str = "tic",
) -> DataFrame:
    """OHLCV per (key, period). `order` decides open and close.

    A single number or time as `order` gives a hash aggregate; a struct with tie columns gives a sort
    aggregate, about three times slower, and is only needed where times of one key repeat.
    """
    order = F.col("ts") if order is None else order
    volume = F.count(F.lit(1)) if volume is None else volume
    return ticks.groupBy(period.alias("date"), key).agg(*ohlcv(F.col(price), order, volume))


def forward_fill(bars: DataFrame, columns: tuple[str, ...] = ("open", "high", "low", "close"),
                 series: Series = DAILY, step: str = "1 day") -> DataFrame:
    """Every ticker gets a row on each session from its first one on; gaps repeat the last prices, volume 0.

    The grid grows from each ticker's own first day (a generator, no cross product) and keeps the days on
    which any ticker traded.
    """
    key = series.key[0]
    last_day = bars.agg(F.max("date").alias("d")).scalar()
    sessions = bars.select("date").distinct()
    grid = (
        bars.groupBy(key).agg(F.min("date").alias("_first"))
        .select(key, F.explode(F.sequence(F.col("_first"), last_day, F.expr(f"INTERVAL {step}"))).alias("date"))
        .join(sessions, "date", "left_semi")
    )
    present = bars.withColumn("_present", F.lit(True))
    wide = grid.join(present, [key, "date"], "left")
    filled = running(wide, series, {c: ("last", c) for c in columns})
    volume = {"volume": F.coalesce("volume", F.lit(0).cast(bars.schema["volume"].dataType))}
    return filled.withColumns(volume).withColumn("filled", F.col("_present").isNull()).drop("_present")


def latest_or_target(bars: DataFrame, target: Column, key: str = "tic") -> DataFrame:
    """One row per ticker: the one on the target day, else the latest; `stale` tells which.

    `max_by` combines map-side, so no ticker's rows meet in one task as they would under `row_number`.
    """
    others = [c for c in bars.columns if c != key]
    pick = F.max_by(F.struct(*others), F.struct((F.col("date") == target).alias("hit"), F.col("date")))
    out = bars.groupBy(key).agg(pick.alias("_row")).select(key, "_row.*")
    return out.withColumn("stale", F.col("date") != target)


def risk_gate(df: DataFrame, column: str = "turbulence", threshold: float = 100.0) -> DataFrame:
    """Flag rows where trading should stop because the risk column is above the threshold."""
    return df.withColumn("risk_off", F.coalesce(F.col(column) > threshold, F.lit(False)))
