"""The market chain: bars with price features, joined to the market-wide sentiment of the day."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from tickloom.operators.features import daily_sentiment, join_by_day
from tickloom.operators.indicators import DEFAULT_PACK, indicator_pack
from tickloom.operators.series import DAILY, Series
from tickloom.plans.daily_features import score_news
from tickloom.session import cut

RENAMED = {f"sentiment_{s}": s for s in ("positive", "negative", "neutral")}


def market_with_sentiment(
    bars: DataFrame, news: DataFrame, scorer: Callable[[DataFrame], DataFrame],
    indicators: Iterable[str] = DEFAULT_PACK, series: Series = DAILY,
) -> DataFrame:
    priced = indicator_pack(cut(bars, "bars"), indicators, series)
    return join_by_day(priced, daily_sentiment(score_news(news, scorer).withColumnsRenamed(RENAMED)))
