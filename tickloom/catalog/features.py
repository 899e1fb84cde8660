"""Queries: daily sentiment, joins and the flagship feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.catalog import sql as S
from tickloom.catalog.registry import query
from tickloom.operators import features as X
from tickloom.plans import inputs as I
from tickloom.plans.daily_features import build_features, keyword_scorer, sentiment_features

SCORER = keyword_scorer(I.POSITIVE, I.NEGATIVE)


@query(
    "daily_features",
    f"""WITH {S.BARS_DAILY}, {S.ALL_SCORED}, {S.DAILY_TIC}
    -- result
    SELECT b.*, {S.FILLED} FROM bars b LEFT JOIN daily d ON b.date = d.date AND b.tic = d.tic""",
    doubles=f"{S.OHLC} {S.MEANS}",
    dates="date",
)
def daily_features(spark, folder):
    """Daily bars with cleaned, labelled and averaged news of their ticker; days without news filled."""
    return sentiment_features(I.bars_daily(spark, folder), I.with_day(I.news(spark, folder)), SCORER)


@query(
    "a1_daily_sentiment_mean",
    f"""WITH {S.ALL_SCORED}
    -- result
    SELECT date, avg(sentiment_positive) AS daily_positive_mean, avg(sentiment_negative) AS daily_negative_mean,
      avg(sentiment_neutral) AS daily_neutral_mean FROM scored GROUP BY date""",
    doubles="daily_positive_mean daily_negative_mean daily_neutral_mean",
    dates="date",
)
def a1(spark, folder):
    return X.daily_sentiment(_short(I.scored_news(spark, folder)))


def _short(scored):
    return scored.withColumnsRenamed({f"sentiment_{s}": s for s in ("positive", "negative", "neutral")})


@query(
    "a2_daily_sentiment_tic",
    f"""WITH {S.ALL_SCORED}, {S.DAILY_TIC}
    -- result
    SELECT * FROM daily""",
    doubles=S.MEANS,
    dates="date",
)
def a2(spark, folder):
    return X.daily_sentiment_by_ticker(I.scored_news(spark, folder))


@query(
    "a3_no_news_fill",
    f"""WITH {S.BARS_DAILY}, {S.ALL_SCORED}, {S.DAILY_TIC}
    -- result
    SELECT b.date, b.tic, {S.FILLED} FROM (SELECT date, tic FROM bars) b
      LEFT JOIN daily d ON b.date = d.date AND b.tic = d.tic""",
    doubles=S.MEANS,
    dates="date",
)
def a3(spark, folder):
    keys = I.ticks(spark, folder).select(I.day().alias("date"), "tic").distinct()
    daily = X.daily_sentiment_by_ticker(I.scored_news(spark, folder))
    return X.no_news_fill(keys.join(daily, ["date", "tic"], "left"))


@query(
    "a4_default_sentiment_cols",
    f"""WITH {S.BARS_DAILY}
    -- result
    SELECT *, CAST(0 AS DOUBLE) AS daily_sentiment_positive_mean, CAST(0 AS DOUBLE) AS daily_sentiment_negative_mean,
      CAST(0 AS DOUBLE) AS daily_sentiment_neutral_mean, CAST(0 AS DOUBLE) AS daily_sentiment_unknown_mean,
      CAST(0 AS BIGINT) AS daily_news_count FROM bars""",
    doubles=S.OHLC,
    dates="date",
)
def a4(spark, folder):
    return X.default_sentiment(I.bars_daily(spark, folder))


@query(
    "a5_agg_first_label",
    f"""WITH {S.NEWS}, {S.CLEANED}, {S.LABELLED}
    -- result
    SELECT date, tic, arg_min(label, row(published_at, id)) AS first_label FROM labelled GROUP BY 1, 2""",
    dates="date",
)
def a5(spark, folder):
    return X.first_label(I.labelled_news(spark, folder), ["date", "tic"], "label", ["published_at", "id"])


@query(
    "a6_agg_majority_label",
    f"""WITH {S.NEWS}, {S.CLEANED}, {S.LABELLED},
    n AS (SELECT date, tic, label, count(*) AS votes FROM labelled GROUP BY ALL)
    -- result
    SELECT date, tic, label AS majority_label, votes FROM n
      QUALIFY row_number() OVER (PARTITION BY date, tic ORDER BY votes DESC, label) = 1""",
    dates="date",
)
def a6(spark, folder):
    return X.majority_label(I.labelled_news(spark, folder), ["date", "tic"], "label")


@query(
    "a7_agg_count_sentiment",
    f"""WITH {S.NEWS}, {S.CLEANED}, {S.LABELLED}
    -- result
    SELECT date, tic, count(*) FILTER (label = 'positive') AS n_positive, count(*) FILTER (label = 'negative') AS n_negative,
      count(*) FILTER (label = 'neutral') AS n_neutral FROM labelled GROUP BY 1, 2""",
    dates="date",
)
def a7(spark, folder):
    return X.label_counts(I.labelled_news(spark, folder), ["date", "tic"], "label")


@query(
    "a8_run_mean_score",
    f"""WITH {S.ALL_SCORED}
    -- result
    SELECT avg(sentiment_positive - sentiment_negative) AS mean_score, count(*) AS articles FROM scored""",
    doubles="mean_score",
)
def a8(spark, folder):
    score = F.col("sentiment_positive") - F.col("sentiment_negative")
    return I.scored_news(spark, folder).agg(F.avg(score).alias("mean_score"), F.count(F.lit(1)).alias("articles"))


@query(
    "j1_left_join_daily",
    f"""WITH {S.BARS_DAILY}, {S.ALL_SCORED}, daily AS (SELECT date, avg(sentiment_positive) AS daily_positive_mean,
      avg(sentiment_negative) AS daily_negative_mean, avg(sentiment_neutral) AS daily_neutral_mean FROM scored GROUP BY date)
    -- result
    SELECT b.*, daily_positive_mean, daily_negative_mean, daily_neutral_mean
      FROM bars b LEFT JOIN daily d ON b.date = d.date""",
    doubles=f"{S.OHLC} daily_positive_mean daily_negative_mean daily_neutral_mean",
    dates="date",
)
def j1(spark, folder):
    return X.join_daily_sentiment(I.bars_daily(spark, folder), _short(I.scored_news(spark, folder)))


@query(
    "j2_left_join_daily_tic",
    f"""WITH {S.BARS_DAILY}, {S.ALL_SCORED}, {S.DAILY_TIC}
    -- result
    SELECT b.date, b.tic, b.close, {S.FILLED} FROM bars b LEFT JOIN daily d ON b.date = d.date AND b.tic = d.tic""",
    doubles=f"close {S.MEANS}",
    dates="date",
)
def j2(spark, folder):
    bars = I.bars_daily(spark, folder).select("date", "tic", "close")
    return X.join_ticker_sentiment(bars, I.scored_news(spark, folder))


@query(
    "j3_single_ticker_fallback",
    f"""WITH {S.BARS_DAILY}, {S.ALL_SCORED}, daily AS (SELECT date, avg(sentiment_positive) AS daily_sentiment_positive_mean,
      avg(sentiment_negative) AS daily_sentiment_negative_mean, avg(sentiment_neutral) AS daily_sentiment_neutral_mean,
      avg(sentiment_unknown) AS daily_sentiment_unknown_mean, count(headline) AS daily_news_count FROM scored GROUP BY 1)
    -- result
    SELECT b.date, b.tic, b.close, {S.FILLED} FROM bars b LEFT JOIN daily d ON b.date = d.date WHERE b.tic = 'view'""",
    doubles=f"close {S.MEANS}",
    dates="date",
)
def j3(spark, folder):
    one = I.bars_daily(spark, folder).select("date", "tic", "close").filter("tic = 'view'")
    return X.join_ticker_sentiment(one, I.scored_news(spark, folder).drop("tic"))


@query(
    "j4_join_vix",
    f"""WITH {S.BARS_DAILY}, {S.INDEX}
    -- result
    SELECT b.*, level AS vix FROM bars b LEFT JOIN idx ON b.date = idx.date""",
    doubles=f"{S.OHLC} vix",
    dates="date",
)
def j4(spark, folder):
    return X.join_market_index(I.bars_daily(spark, folder), I.index_levels(spark, folder))


@query(
    "j6_cross_join_scalar",
    f"""WITH {S.BARS_DAILY}, {S.ALL_SCORED}
    -- result
    SELECT date, tic, close, (SELECT avg(CAST(label <> 'neutral' AS DOUBLE)) FROM scored) AS daily_avg_sentiment_score
      FROM bars""",
    doubles="close daily_avg_sentiment_score",
    dates="date",
)
def j6(spark, folder):
    scored = I.labelled_news(spark, folder).select(
        F.when(F.col("label") != "neutral", 1.0).otherwise(0.0).alias("sentiment_score")
    )
    return X.add_run_mean(I.bars_daily(spark, folder).select("date", "tic", "close"), scored)


@query(
    "j7_anti_join_failed",
    """
    -- result
    SELECT DISTINCT p_brand AS tic FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_size = 1)""",
)
def j7(spark, folder):
    part = I.table(spark, folder, "part").withColumnRenamed("p_brand", "tic")
    failed = part.filter("p_size = 1").select("tic").distinct()
    return X.failed_removed(part.select("tic").distinct(), failed)


@query(
    "j8_semi_join_universe",
    f"""WITH {S.BARS_LONG}, universe AS (SELECT DISTINCT p_brand AS tic FROM part WHERE p_size <= 2)
    -- result
    SELECT * FROM bars WHERE tic IN (SELECT tic FROM universe)""",
    doubles=f"{S.OHLC} volume",
    dates="date",
    digits=9,
)
def j8(spark, folder):
    universe = I.table(spark, folder, "part").filter("p_size <= 2").select(F.col("p_brand").alias("tic")).distinct()
    return X.in_universe(I.bars_long(spark, folder), universe)


@query(
    "j8_universe_without_data",
    """WITH universe AS (SELECT CAST(c_custkey AS VARCHAR) AS tic FROM customer)
    -- result
    SELECT tic FROM universe WHERE tic NOT IN (SELECT CAST(o_custkey AS VARCHAR) FROM orders)""",
)
def j8_missing(spark, folder):
    universe = I.table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("tic"))
    bars = I.table(spark, folder, "orders").select(F.col("o_custkey").cast("string").alias("tic"))
    return X.without_data(universe, bars)


@query(
    "j10_asof_next_session",
    f"""WITH {S.BARS_LONG}, orders_news AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS date,
      'Brand#' || (1 + o_custkey % 5) || (1 + (o_custkey // 5) % 5) AS tic FROM orders)
    -- result
    SELECT n.id, n.tic, n.date, b.date AS session FROM orders_news n ASOF LEFT JOIN bars b ON n.tic = b.tic AND n.date <= b.date""",
    dates="date session",
)
def j10(spark, folder):
    """Orders as dated articles of a brand, moved to that brand's next trading day."""
    articles = I.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.to_date("o_orderdate").alias("date"),
        F.concat(
            F.lit("Brand#"), 1 + F.pmod("o_custkey", F.lit(5)), 1 + F.pmod(F.floor(F.col("o_custkey") / 5), F.lit(5))
        ).alias("tic"),
    )
    return X.shift_to_session(articles, I.bars_long(spark, folder).select("tic", "date")).select(
        "id", "tic", "date", "session"
    )


@query(
    "build_features_full",
    f"""WITH RECURSIVE {S.BARS_DAILY}, {S.INDEX}, {S.ALL_SCORED}, {S.DAILY_TIC}, {S.smoothed()}
    -- result
    SELECT s.date, s.tic, s.open, s.high, s.low, s.close, s.volume, false AS filled, r.e20 AS ema_20_raw, level AS vix,
      CASE WHEN s.rn >= 26 THEN r.e12 - r.e26 END AS macd,
      CASE WHEN s.rn >= 34 THEN r.sig END AS macd_signal,
      CASE WHEN s.rn >= 34 THEN r.e12 - r.e26 - r.sig END AS macd_diff,
      CASE WHEN s.rn >= 14 THEN CASE WHEN l14 = 0 THEN 100.0 ELSE 100 - 100 / (1 + g14 / l14) END END AS rsi_14,
      CASE WHEN s.rn >= 20 THEN avg(s.close) OVER (PARTITION BY s.tic ORDER BY s.date ROWS 19 PRECEDING) END AS close_20_sma,
      CASE WHEN s.rn >= 20 THEN r.e20 END AS ema_20,
      {S.FILLED} FROM s JOIN r ON s.tic = r.tic AND s.rn = r.rn JOIN idx ON s.date = idx.date
      LEFT JOIN daily d ON s.date = d.date AND s.tic = d.tic""".replace(" r.e20 AS ema_20_raw,", ""),
    doubles=f"{S.OHLC} vix macd macd_signal macd_diff rsi_14 close_20_sma ema_20 {S.MEANS}",
    dates="date",
)
def full(spark, folder):
    """Gap fill, indicators, market index and sentiment in one plan."""
    return build_features(
        I.bars_daily(spark, folder), I.with_day(I.news(spark, folder)), SCORER,
        indicators=("macd", "rsi_14", "close_20_sma", "ema_20"), index=I.index_levels(spark, folder),
    )
