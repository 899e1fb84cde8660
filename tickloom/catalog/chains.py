"""Queries: whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.catalog import sql as S
from tickloom.catalog.features import SCORER
from tickloom.catalog.indicators import BASKETS, MACD, RSI, basket_turbulence
from tickloom.catalog.registry import query
from tickloom.plans import finetune as FT
from tickloom.plans import inputs as I
from tickloom.plans import one_day as OD
from tickloom.plans.daily_features import build_features
from tickloom.plans.market_sentiment import market_with_sentiment
from tickloom.session import cut, scratch_path

SMA20 = "CASE WHEN s.rn >= 20 THEN avg(s.close) OVER (PARTITION BY s.tic ORDER BY s.date ROWS 19 PRECEDING) END"


@query(
    "chain_market_sentiment",
    f"""WITH RECURSIVE {S.BARS_DAILY}, {S.ALL_SCORED}, {S.smoothed()}, daily AS (SELECT date, avg(sentiment_positive) AS daily_positive_mean,
      avg(sentiment_negative) AS daily_negative_mean, avg(sentiment_neutral) AS daily_neutral_mean FROM scored GROUP BY date),
    p AS (SELECT s.date, s.tic, s.open, s.high, s.low, s.close, s.volume, {SMA20} AS close_20_sma, {RSI.replace('rn >=', 's.rn >=')} AS rsi_14
      FROM s JOIN r ON s.tic = r.tic AND s.rn = r.rn)
    -- result
    SELECT p.*, daily_positive_mean, daily_negative_mean, daily_neutral_mean FROM p LEFT JOIN daily d ON p.date = d.date""",
    doubles=f"{S.OHLC} close_20_sma rsi_14 daily_positive_mean daily_negative_mean daily_neutral_mean", dates="date",
)
def chain_market(spark, folder):
    news = I.with_day(I.news(spark, folder))
    return market_with_sentiment(I.bars_daily(spark, folder), news, SCORER, ("close_20_sma", "rsi_14"))


@query(
    "chain_features_risk",
    f"""WITH {BASKETS}, idx AS (SELECT date, CAST(sum(volume) AS DOUBLE) AS vix FROM bars GROUP BY 1)
    -- result
    SELECT date, tic, vix, round(turbulence, 4) AS turbulence, coalesce(turbulence > 6, false) AS risk_off FROM bars LEFT JOIN idx USING (date) LEFT JOIN turb USING (date)""",
    doubles="vix turbulence", dates="date",
)
def chain_features_risk(spark, folder):
    """The feature job with market index, turbulence of baskets and risk flag."""
    bars = I.bars_long(spark, folder)
    index = bars.groupBy("date").agg(F.sum("volume").cast("double").alias("level"))
    out = build_features(bars, None, SCORER, ("close_20_sma",), index, fill_gaps=False, risk=basket_turbulence, threshold=6.0)
    return out.select("date", "tic", "vix", F.round("turbulence", 4).alias("turbulence"), "risk_off")


@query(
    "chain_one_day",
    f"""WITH RECURSIVE {S.BARS_DAILY}, {S.NEWS}, {S.smoothed()}, today AS MATERIALIZED (SELECT {S.processed('headline')} AS t FROM news WHERE date = DATE '2024-01-29'),
    p AS (SELECT s.date, s.tic, s.close, {SMA20} AS sma_20, CAST(NULL AS DOUBLE) AS sma_50, CASE WHEN s.rn >= 20 THEN e20 END AS ema_20,
      CAST(NULL AS DOUBLE) AS ema_50, {RSI.replace('rn >=', 's.rn >=')} AS rsi, {MACD.replace('rn >=', 's.rn >=')} FROM s JOIN r ON s.tic = r.tic AND s.rn = r.rn)
    -- result
    SELECT *, (SELECT avg(1.0) FROM today) AS daily_avg_sentiment_score FROM p WHERE date = DATE '2024-01-29'""",
    doubles="close sma_20 ema_20 rsi macd macd_signal macd_diff daily_avg_sentiment_score", dates="date",
)
def chain_one_day(spark, folder):
    """Indicators of 29 January from all days up to it, with the mean score of that day's articles."""
    bars = cut(I.bars_daily(spark, folder), "bars")
    indicators = OD.day_indicators(bars, "2024-01-29")
    scored = OD.day_news(I.with_day(I.news(spark, folder)), "2024-01-29", I.POSITIVE, I.NEGATIVE)
    return OD.day_features(indicators, scored).drop("open", "high", "low", "volume", "vix", "turbulence")


@query(
    "chain_one_day_news",
    f"""WITH {S.NEWS}, t AS MATERIALIZED (SELECT id, {S.processed('summary')} AS processed_text FROM news WHERE date = DATE '2024-01-10')
    -- result
    SELECT id, processed_text, {S.label('processed_text')} AS sentiment_label, 1.0::DOUBLE AS sentiment_score FROM t""",
)
def chain_one_day_news(spark, folder):
    news = I.with_day(I.news(spark, folder))
    scored = OD.day_news(news, "2024-01-10", I.POSITIVE, I.NEGATIVE, text=F.col("summary"))
    return scored.select("id", "processed_text", "sentiment_label", "sentiment_score")


@query(
    "chain_finetune",
    f"""WITH d AS (SELECT doc_id, text, lower(text) AS t FROM documents)
    -- result
    SELECT doc_id, 'Analyze sentiment:' AS instruction, text AS input, {S.label('t')} AS output,
      CASE WHEN ('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT < 429496729 THEN 'validation' ELSE 'train' END AS part FROM d""",
)
def chain_finetune(spark, folder):
    """Documents to JSON lines by part, and back."""
    rows = FT.finetune_rows(I.documents(spark, folder), "doc_id", "text", I.POSITIVE, I.NEGATIVE)
    base = FT.write_finetune(rows, scratch_path(spark, "finetune"))
    schema = T.StructType.fromDDL("doc_id bigint, instruction string, input string, output string")
    train, validation = (FT.read_finetune(spark, base, p, schema) for p in ("train", "validation"))
    return train.unionByName(validation)
