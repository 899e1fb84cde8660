"""Profiles from stored sketches: a row for each day and column, merged to any range of days without reading rows again.

A row holds count, mean, sum of squared deviations, extremes, a KLL sketch for quantiles and a HyperLogLog sketch for distinct
values. Sizes are bounded by the sketches' accuracy, so the state of a day does not grow with its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.frames import numeric_columns

QUANTILE_SIZE = 800  # entries of a KLL level: ranks are about 0.4 % off at most in nearly all cases
DISTINCT_BITS = 14  # 2^14 registers: distinct counts are about 0.8 % off on average


def daily_sketches(df: DataFrame, day: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """(day, column, count, mean, m2, min, max, quantiles, values) of numeric columns; NULLs are not counted."""
    columns = list(columns or numeric_columns(df))
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in columns)
    long = df.withColumn("day", day).selectExpr("day", f"stack({len(columns)}, {pairs}) AS (`column`, value)").where("value IS NOT NULL")
    return long.groupBy("day", "column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), (F.var_pop("value") * F.count("value")).alias("m2"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.kll_sketch_agg_double("value", F.lit(QUANTILE_SIZE)).alias("quantiles"), F.hll_sketch_agg(F.xxhash64("value"), F.lit(DISTINCT_BITS)).alias("values"),
    )


def merged(state: DataFrame, keys: Sequence[str] = ("column",)) -> DataFrame:
    """Rows of daily_sketches(), of any days, put together for each of `keys`."""
    total, mean = F.sum("count"), F.sum(F.col("count") * F.col("mean")) / F.sum("count")
    # Deviations within the days and of the days' means, about the mean of the means: close to that of all, so little cancels.
    sums = state.join(state.groupBy(*keys).agg(F.avg("mean").alias("_about")), list(keys)).groupBy(*keys).agg(
        total.alias("count"), mean.alias("mean"),
        (F.sum(F.col("m2") + F.col("count") * F.pow(F.col("mean") - F.col("_about"), 2)) - total * F.pow(mean - F.first("_about"), 2)).alias("m2"),
        F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"), F.hll_union_agg("values").alias("values"),
    )
    return sums


def described(state: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """count, mean, std, min, max, quantiles (p25, ...) and distinct values of rows of merged() or daily_sketches()."""
    others = [c for c in state.columns if c not in ("m2", "quantiles", "values", "count", "mean", "min", "max")]
    std = F.when(F.col("count") > 1, F.sqrt(F.col("m2") / (F.col("count") - 1)))
    points = [F.kll_sketch_get_quantile_double("quantiles", F.lit(float(q))).alias(f"p{round(100 * q)}") for q in quantiles]
    return state.select(*others, "count", "mean", std.alias("std"), "min", "max", *points, F.hll_sketch_estimate("values").alias("distinct"))


def measured(df: DataFrame, found: DataFrame, columns: Sequence[str], rank_error: float = 0.01, count_error: float = 0.05) -> DataFrame:
    """How far the quantiles and distinct counts of `found` (described()) are from those of the rows, for each column.

    (column, count, p25_ok, p50_ok, p75_ok, distinct_ok): a quantile is right if its rank, or that of a value equal to it, is
    `rank_error` off at most; a distinct count if it is off by a share of `count_error` at most.
    """
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in columns)
    long = df.selectExpr(f"stack({len(columns)}, {pairs}) AS (`column`, value)").where("value IS NOT NULL")
    points = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    # One row for each value of a column, then one for each column.
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    judged = counts.join(F.broadcast(found.select("column", *points, "distinct")), "column")
    below = [F.sum(F.when(F.col("value") < F.col(p), F.col("n")).otherwise(0)).alias(f"under_{p}") for p in points]
    upto = [F.sum(F.when(F.col("value") <= F.col(p), F.col("n")).otherwise(0)).alias(f"upto_{p}") for p in points]
    sums = judged.groupBy("column").agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("kinds"), F.first("distinct").alias("distinct"), *below, *upto)
    right = [((F.col(f"under_{p}") <= (q + rank_error) * F.col("count")) & (F.col(f"upto_{p}") >= (q - rank_error) * F.col("count"))).alias(f"{p}_ok") for p, q in points.items()]
    close = F.abs(F.col("distinct") - F.col("kinds")) <= count_error * F.col("kinds")
    return sums.select("column", "count", *right, close.alias("distinct_ok"))
