"""Daily sentiment, its join to bars, and market-wide columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.constants import SENTIMENTS

MEANS = tuple(f"daily_sentiment_{s}_mean" for s in (*SENTIMENTS, "unknown"))
NEWS_COUNT = "daily_news_count"


def daily_sentiment(news: DataFrame, scores: Sequence[str] = ("positive", "negative", "neutral")) -> DataFrame:
    """Market-wide mean scores per day."""
    return news.groupBy("date").agg(*[F.avg(s).alias(f"daily_{s}_mean") for s in scores])


def daily_sentiment_by_ticker(news: DataFrame, keys: Sequence[str] = ("date", "tic")) -> DataFrame:
    """Mean of the four scores and the number of headlines per day and ticker."""
    means = [F.avg(f"sentiment_{s}").alias(m) for s, m in zip((*SENTIMENTS, "unknown"), MEANS)]
    return news.groupBy(*keys).agg(*means, F.count("headline").alias(NEWS_COUNT))


def no_news_fill(df: DataFrame) -> DataFrame:
    """Days without a headline count as unknown, not as neutral."""
    count = F.coalesce(F.col(NEWS_COUNT), F.lit(0))
    filled = {
        m: F.when(count == 0, F.lit(1.0 if m == MEANS[3] else 0.0)).otherwise(F.coalesce(m, F.lit(0.0)))
        for m in MEANS
    }
    return df.withColumns({**filled, NEWS_COUNT: count.cast("long")})


def default_sentiment(bars: DataFrame) -> DataFrame:
    """Sentiment columns of a run that has no news at all: all zero. Columns already there stay."""
    new = {m: F.lit(0.0) for m in MEANS if m not in bars.columns}
    if NEWS_COUNT not in bars.columns:
        new[NEWS_COUNT] = F.lit(0).cast("long")
    return bars.withColumns(new)


def join_by_day(bars: DataFrame, daily: DataFrame) -> DataFrame:
    """Left join of a table with one row per date; Spark broadcasts it if its measured size allows."""
    return bars.join(daily, "date", "left")


def one_row_per_day(daily: DataFrame, column: str) -> DataFrame:
    """(date, column), refusing a second row of a day: what is broadcast is bounded by the calendar."""
    rows = daily.groupBy("date").agg(F.count(F.lit(1)).alias("_n"), F.any_value(column).alias("_v"))
    twice = F.raise_error(F.concat(F.lit("several rows on "), F.col("date").cast("string")))
    return rows.select("date", F.when(F.col("_n") == 1, F.col("_v")).otherwise(twice.cast("double")).alias(column))


def join_daily_sentiment(bars: DataFrame, scored: DataFrame) -> DataFrame:
    """Bars with the market-wide daily means."""
    return join_by_day(bars, daily_sentiment(scored))


def join_ticker_sentiment(bars: DataFrame, scored: DataFrame | None) -> DataFrame:
    """Bars with daily sentiment of their ticker, days without news filled.

    The news side has one row per (day, ticker), so the keys of the join cannot be skewed; Spark picks
    broadcast or shuffle from the measured size. News without a ticker column is joined by day when the
    bars hold one ticker only; otherwise bars come back as they are.
    """
    if scored is None:
        return default_sentiment(bars)
    if "tic" in scored.columns:
        return no_news_fill(bars.join(daily_sentiment_by_ticker(scored), ["date", "tic"], "left"))
    return single_ticker_join(bars, scored)


def single_ticker_join(bars: DataFrame, scored: DataFrame) -> DataFrame:
    """Day-only join that takes effect when the bars hold exactly one ticker.

    Whether they do is decided by a scalar subquery in the same plan, so no job runs beforehand. With
    several tickers the sentiment columns are NULL.
    """
    one = bars.agg((F.min("tic") == F.max("tic")).alias("one")).scalar()
    daily = daily_sentiment_by_ticker(scored, ["date"])
    joined = no_news_fill(join_by_day(bars, daily))
    return joined.withColumns({c: F.when(one, F.col(c)) for c in (*MEANS, NEWS_COUNT)})


def join_market_index(bars: DataFrame, index: DataFrame, name: str = "vix") -> DataFrame:
    """Index level of the day on every ticker's row. `index` has one row per day: (date, level)."""
    return join_by_day(bars, one_row_per_day(index, "level").withColumnRenamed("level", name))


def join_turbulence(bars: DataFrame, turbulence: DataFrame, index_column: str = "vix") -> DataFrame:
    """Turbulence of the day, only when the market index is usable; otherwise the column is NULL."""
    usable = bars.agg((F.count(index_column) > 0).alias("usable")).scalar()
    joined = join_by_day(bars, one_row_per_day(turbulence, "turbulence"))
    return joined.withColumn("turbulence", F.when(usable, F.col("turbulence")))


def add_run_mean(df: DataFrame, news: DataFrame, score: str = "sentiment_score",
                 name: str = "daily_avg_sentiment_score") -> DataFrame:
    """The run-wide mean score on every row, as a scalar subquery."""
    return df.withColumn(name, news.agg(F.avg(score).alias("m")).scalar())


def failed_removed(requested: DataFrame, failed: DataFrame, key: str = "tic") -> DataFrame:
    return requested.join(failed, key, "left_anti")


def in_universe(bars: DataFrame, universe: DataFrame, key: str = "tic") -> DataFrame:
    return bars.join(universe, key, "left_semi")


def without_data(universe: DataFrame, bars: DataFrame, key: str = "tic") -> DataFrame:
    """Tickers of the universe that have no bars. Bars are reduced to distinct keys before they are shuffled."""
    return universe.join(bars.select(key).distinct(), key, "left_anti")


def next_session(news_days: DataFrame, sessions: DataFrame, key: str = "tic") -> DataFrame:
    """For each (key, day) of news the first session on or after it; NULL after the last session.

    Both sides are first reduced to distinct (key, day) pairs, so a key's group is bounded by the calendar.
    """
    pairs = (
        sessions.select(key, "date").distinct().withColumn("_session", F.col("date"))
        .unionByName(news_days.select(key, "date").distinct().withColumn("_session", F.lit(None).cast("date")))
        .groupBy(key, "date").agg(F.max("_session").alias("_session"), F.count(F.lit(1)).alias("_n"))
    )
    # Backwards with a growing frame: a frame that reaches forward to the end is re-read for every row.
    ahead = Window.partitionBy(key).orderBy(F.desc("date")).rowsBetween(Window.unboundedPreceding, 0)
    found = pairs.withColumn("session", F.last("_session", ignorenulls=True).over(ahead))
    return found.filter((F.col("_n") == 2) | F.col("_session").isNull()).select(key, "date", "session")


def shift_to_session(news: DataFrame, sessions: DataFrame, key: str = "tic") -> DataFrame:
    """News with `session`, the trading day it counts for."""
    return news.join(next_session(news, sessions, key), [key, "date"], "left")


def first_label(news: DataFrame, keys: Sequence[str], label: str, order: Sequence[str]) -> DataFrame:
    return news.groupBy(*keys).agg(F.min_by(label, F.struct(*order)).alias("first_label"))


def majority_label(news: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Most frequent label per group; equal counts go to the alphabetically first."""
    counts = news.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min_by(F.col(label), F.struct(-F.col("_n"), F.col(label)))
    return counts.groupBy(*keys).agg(best.alias("majority_label"), F.max("_n").alias("votes"))


def label_counts(news: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    return news.groupBy(*keys).agg(*[F.count_if(F.col(label) == s).alias(f"n_{s}") for s in SENTIMENTS])


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
