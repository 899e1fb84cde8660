"""The feature job: ticks and articles in, one model-ready row per ticker and day out."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from tickloom.functions.labels import label_scores
from tickloom.functions.text import keyword_label, process_text
from tickloom.operators.bars import forward_fill, risk_gate
from tickloom.operators.features import join_market_index, join_ticker_sentiment, join_turbulence
from tickloom.operators.indicators import DEFAULT_PACK, indicator_pack
from tickloom.operators.series import DAILY, Series
from tickloom.session import cut


def keyword_scorer(positive: Iterable[str], negative: Iterable[str]) -> Callable[[DataFrame], DataFrame]:
    """Scorer that reads the label from keyword lists; a model-backed one has the same shape."""
    pos, neg = tuple(positive), tuple(negative)

    def score(news: DataFrame) -> DataFrame:
        return news.withColumns(label_scores(keyword_label("processed_text", pos, neg)))

    return score


def score_news(news: DataFrame, scorer: Callable[[DataFrame], DataFrame], text: str = "summary") -> DataFrame:
    return scorer(news.withColumn("processed_text", process_text(text)))


def sentiment_features(
    bars: DataFrame, news: DataFrame | None, scorer: Callable[[DataFrame], DataFrame], enabled: bool = True
) -> DataFrame:
    """Bars joined to the daily sentiment of their ticker."""
    if news is None or not enabled:
        return join_ticker_sentiment(bars, None)
    return join_ticker_sentiment(bars, score_news(news, scorer))


def build_features(
    bars: DataFrame,
    news: DataFrame | None,
    scorer: Callable[[DataFrame], DataFrame],
    indicators: Iterable[str] = DEFAULT_PACK,
    index: DataFrame | None = None,
    fill_gaps: bool = True,
    series: Series = DAILY,
    risk: Callable[[DataFrame], DataFrame] | None = None,
    threshold: float = 100.0,
    index_column: str = "vix",
) -> DataFrame:
    """Gap-filled bars, indicators, market index, turbulence of the day with a risk flag, and daily sentiment.

    `risk` makes (date, turbulence) of the bars; it is joined where the market index is usable, and the flag tells whether it
    is over `threshold`.

    Bars are read by several steps, so they are written once to the shared scratch folder: the ticks below
    them, far larger, are scanned once. The rest is one lazy plan.
    """
    bars = cut(bars, "bars")
    out = cut(forward_fill(bars, series=series), "filled") if fill_gaps else bars
    out = indicator_pack(out, indicators, series)
    if index is not None:
        out = join_market_index(out, index, index_column)
    if risk is not None:
        out = risk_gate(join_turbulence(out, cut(risk(bars), "turbulence"), index_column), threshold=threshold)
    return sentiment_features(out, news, scorer)
