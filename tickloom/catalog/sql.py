"""SQL of the logical tables, shared by the checks. Each fragment is the body of a WITH entry."""

from tickloom.functions.constants import PUNCTUATION, STOPWORDS
from tickloom.plans.inputs import NEGATIVE, POSITIVE, TICKERS


def quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def _bars(period: str) -> str:
    return f"""(SELECT {period} AS date, event_type AS tic, arg_min(value, row(ts, event_id)) AS open,
  max(value) AS high, min(value) AS low, arg_max(value, row(ts, event_id)) AS close, count(*) AS volume
  FROM events GROUP BY 1, 2)"""


BARS_DAILY = "bars AS " + _bars("CAST(ts AS DATE)")
BARS_HOURLY = "bars AS " + _bars("date_trunc('hour', ts)")
BARS_LONG = """bars AS (SELECT CAST(l_shipdate AS DATE) AS date, p_brand AS tic,
  arg_min(l_extendedprice / l_quantity, row(l_orderkey, l_linenumber)) AS open,
  max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
  arg_max(l_extendedprice / l_quantity, row(l_orderkey, l_linenumber)) AS close, sum(l_quantity) AS volume
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""
INDEX = "idx AS (SELECT CAST(ts AS DATE) AS date, avg(value) AS level FROM events GROUP BY 1)"
NEWS = f"""news AS (SELECT doc_id AS id, CAST(DATE '2024-01-01' + CAST(doc_id % 29 AS INTEGER) AS TIMESTAMP) AS published_at,
  CAST(DATE '2024-01-01' + CAST(doc_id % 29 AS INTEGER) AS DATE) AS date,
  list_extract([{quoted(TICKERS)}], CAST((doc_id // 29) % 5 AS INTEGER) + 1) AS tic,
  split_part(text, '.', 1) AS headline, text AS summary, source AS source_name, lang FROM documents)"""
WS = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"[\p{L}\p{N}_]"


def no_html(x: str) -> str:
    return rf"regexp_replace({x}, '<[^\n]*?>', '', 'g')"


def no_urls(x: str) -> str:
    return rf"regexp_replace({x}, '(http|www)[^{WS}]+', '', 'g')"


def no_punctuation(x: str) -> str:
    return f"translate({x}, {quoted([PUNCTUATION])}, '')"


def no_stopwords(x: str) -> str:
    return (
        f"array_to_string(list_filter(string_split_regex({x}, '[{WS}]+'), "
        f"lambda w: w <> '' AND w NOT IN ({quoted(STOPWORDS)})), ' ')"
    )


def processed(x: str) -> str:
    return no_stopwords(no_punctuation(f"lower({no_urls(no_html(x))})"))


def hits(x: str, keywords) -> str:
    return " + ".join(
        f"CAST(regexp_matches({x}, '(^|[^\\p{{L}}\\p{{N}}_]){k}($|[^\\p{{L}}\\p{{N}}_])') AS INTEGER)" for k in keywords
    )


def label(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL OR {x} = '' THEN 'neutral' WHEN {hits(x, POSITIVE)} > {hits(x, NEGATIVE)} THEN 'positive' "
        f"WHEN {hits(x, NEGATIVE)} > {hits(x, POSITIVE)} THEN 'negative' ELSE 'neutral' END"
    )


CLEANED = f"cleaned AS MATERIALIZED (SELECT *, {processed('summary')} AS processed_text FROM news)"
LABELLED = f"labelled AS MATERIALIZED (SELECT *, {label('processed_text')} AS label FROM cleaned)"
SCORED = """scored AS (SELECT *, CAST(label = 'positive' AS DOUBLE) AS sentiment_positive,
  CAST(label = 'negative' AS DOUBLE) AS sentiment_negative, CAST(label = 'neutral' AS DOUBLE) AS sentiment_neutral,
  CAST(0 AS DOUBLE) AS sentiment_unknown FROM labelled)"""
ALL_SCORED = f"{NEWS}, {CLEANED}, {LABELLED}, {SCORED}"
DAILY_TIC = """daily AS (SELECT date, tic, avg(sentiment_positive) AS daily_sentiment_positive_mean,
  avg(sentiment_negative) AS daily_sentiment_negative_mean, avg(sentiment_neutral) AS daily_sentiment_neutral_mean,
  avg(sentiment_unknown) AS daily_sentiment_unknown_mean, count(headline) AS daily_news_count FROM scored GROUP BY 1, 2)"""
FILLED = """CASE WHEN coalesce(daily_news_count, 0) = 0 THEN 0.0 ELSE coalesce(daily_sentiment_positive_mean, 0.0) END AS daily_sentiment_positive_mean,
  CASE WHEN coalesce(daily_news_count, 0) = 0 THEN 0.0 ELSE coalesce(daily_sentiment_negative_mean, 0.0) END AS daily_sentiment_negative_mean,
  CASE WHEN coalesce(daily_news_count, 0) = 0 THEN 0.0 ELSE coalesce(daily_sentiment_neutral_mean, 0.0) END AS daily_sentiment_neutral_mean,
  CASE WHEN coalesce(daily_news_count, 0) = 0 THEN 1.0 ELSE coalesce(daily_sentiment_unknown_mean, 0.0) END AS daily_sentiment_unknown_mean,
  coalesce(daily_news_count, 0) AS daily_news_count"""
MEANS = (
    "daily_sentiment_positive_mean daily_sentiment_negative_mean daily_sentiment_neutral_mean daily_sentiment_unknown_mean"
)
OHLC = "open high low close"


def smoothed(bars: str = "bars", more: str = "") -> str:
    """Exponential means by plain recursion: 12, 20, 26 and 50 spans, gains and losses (1/14), and the signal line."""
    def step(col: str, x: str, a: str) -> str:
        return f"r.{col} * (1 - {a}) + {x} * {a}"

    e12, e26 = step("e12", "s.close", "(2.0/13)"), step("e26", "s.close", "(2.0/27)")
    return f"""s AS MATERIALIZED (SELECT *, row_number() OVER w AS rn,
  greatest(coalesce(close - lag(close) OVER w, 0), 0) AS gain,
  greatest(coalesce(lag(close) OVER w - close, 0), 0) AS loss FROM {bars} WINDOW w AS (PARTITION BY tic ORDER BY date)),
r AS (SELECT tic, date, rn, CAST(close AS DOUBLE) AS e12, CAST(close AS DOUBLE) AS e20, CAST(close AS DOUBLE) AS e26,
  CAST(close AS DOUBLE) AS e50, CAST(gain AS DOUBLE) AS g14, CAST(loss AS DOUBLE) AS l14, CAST(NULL AS DOUBLE) AS sig
  FROM s WHERE rn = 1
  UNION ALL
  SELECT s.tic, s.date, s.rn, {e12}, {step('e20', 's.close', '(2.0/21)')}, {e26}, {step('e50', 's.close', '(2.0/51)')},
  {step('g14', 's.gain', '(1.0/14)')}, {step('l14', 's.loss', '(1.0/14)')},
  CASE WHEN s.rn < 26 THEN NULL WHEN s.rn = 26 THEN ({e12}) - ({e26})
  ELSE r.sig * 0.8 + (({e12}) - ({e26})) * 0.2 END
  FROM r JOIN s ON s.tic = r.tic AND s.rn = r.rn + 1)"""
