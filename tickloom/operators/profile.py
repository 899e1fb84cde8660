"""Profiles of tables: summary statistics, counts, correlations, histograms, resampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.frames import numeric_columns
from tickloom.operators.ranks import exact_quantiles


def unpivot(df: DataFrame, columns: Sequence[str], kind: str, name: str = "column", value: str = "value") -> DataFrame:
    """One row per column and row."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS {kind})" for c in columns)
    return df.selectExpr(f"stack({len(columns)}, {pairs}) AS (`{name}`, `{value}`)")


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column.

    Quartiles are exact by default. `approximate` reads them from a sketch in the same pass instead, for
    tables where a second, ordered pass is not worth it.
    """
    columns = list(columns or numeric_columns(df))
    # Rows carry the column's number instead of its name until the end.
    pairs = ", ".join(f"{i}, CAST(`{c}` AS DOUBLE)" for i, c in enumerate(columns))
    long = df.selectExpr(f"stack({len(columns)}, {pairs}) AS (`column`, value)")
    named = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("column") + 1)
    stats = [
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    ]
    if approximate:
        q = F.approx_percentile("value", [0.25, 0.5, 0.75], 10000)
        out = long.groupBy("column").agg(*stats, q.alias("_q"))
        return out.select("*", *[F.col("_q")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))]).drop("_q").withColumn("column", named)
    quartiles = exact_quantiles(long, "column", "value", [0.25, 0.5, 0.75])
    quartiles = quartiles.withColumnsRenamed({"q0": "p25", "q1": "p50", "q2": "p75"})
    return long.groupBy("column").agg(*stats).join(quartiles, "column", "left").withColumn("column", named)


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, unique, top and freq per text column; equal counts go to the alphabetically first value."""
    long = unpivot(df, columns, "STRING").filter("value IS NOT NULL")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"), F.max("n").alias("freq"),
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or df.columns)
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return unpivot(row, columns, "BIGINT", value="nulls")


def table_counts(df: DataFrame, key: str = "tic", approximate: bool = False) -> DataFrame:
    """Rows, columns and tickers."""
    tickers = F.approx_count_distinct(key) if approximate else F.count_distinct(key)
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.first(F.lit(len(df.columns))).cast("long").alias("columns"),
        tickers.alias("tickers"),
    )


def date_bounds(df: DataFrame, column: str = "date") -> DataFrame:
    return df.agg(F.min(column).alias("first"), F.max(column).alias("last"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair over the rows where both are known; one pass for all pairs."""
    columns = list(columns)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    both = [(a, b, i) for i, (a, b) in enumerate(pairs)] + [(b, a, i) for i, (a, b) in enumerate(pairs) if a != b]
    stacked = ", ".join(f"'{a}', '{b}', `{i}`" for a, b, i in both)
    return row.selectExpr(f"stack({len(both)}, {stacked}) AS (left_column, right_column, correlation)")


def monthly_mean(df: DataFrame, columns: Sequence[str], date: str = "date") -> DataFrame:
    """Means per month, labelled by the month's last day; months without rows are kept as NULL."""
    means = df.groupBy(F.last_day(date).alias("month")).agg(*[F.avg(c).alias(c) for c in columns])
    span = df.agg(F.trunc(F.min(date), "month").alias("lo"), F.trunc(F.max(date), "month").alias("hi"))
    firsts = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("first"))
    months = firsts.select(F.last_day("first").alias("month"))
    return months.join(means, "month", "left")


def histogram(df: DataFrame, column: str, bins: int, by: Sequence[Column] = ()) -> DataFrame:
    """Counts in `bins` equal steps from the smallest to the largest value; empty steps are kept."""
    known = df.filter(F.col(column).isNotNull())
    lo = known.agg(F.min(column).cast("double")).scalar()
    hi = known.agg(F.max(column).cast("double")).scalar()
    step = F.least(
        F.coalesce(F.width_bucket(F.col(column).cast("double"), lo, hi, F.lit(bins)), F.lit(1)), F.lit(bins)
    ).cast("long")
    counts = known.groupBy(*by, step.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    if by:
        return counts
    every = df.sparkSession.range(1, bins + 1).withColumnRenamed("id", "bin")
    filled = every.join(counts, "bin", "left")
    width = (hi - lo) / bins
    return filled.select(
        "bin", (lo + (F.col("bin") - 1) * width).alias("from_value"), F.coalesce("n", F.lit(0)).alias("n")
    )


def ticker_series(df: DataFrame, ticker: str, column: str) -> DataFrame:
    return df.filter(F.col("tic") == ticker).select("date", column).orderBy("date")


def fetch_coverage(requested: DataFrame, rows: DataFrame, key: str = "tic") -> DataFrame:
    """Tickers asked for, fetched and failed. Fetched rows are reduced to distinct keys before the join."""
    got = rows.select(key).distinct().withColumn("_got", F.lit(True))
    return requested.join(got, key, "left").agg(
        F.count(F.lit(1)).alias("attempted"), F.count("_got").alias("fetched"),
        F.count_if(F.col("_got").isNull()).alias("failed"),
    )


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def label_distribution(df: DataFrame, source: str, label: str) -> DataFrame:
    """Counts per (source, label), per source and overall. The roll-up runs over the counted pairs."""
    pairs = counts_by(df, source, label)
    return pairs.rollup(source, label).agg(F.sum("n").alias("n"))
