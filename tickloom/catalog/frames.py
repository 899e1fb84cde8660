"""Queries: column, filter, order, set and split steps."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.catalog import sql as S
from tickloom.catalog.registry import query
from tickloom.operators import frames as X
from tickloom.plans import inputs as I
from tickloom.schemas import OHLCV


@query(
    "b1_canon_columns",
    """-- result
    SELECT event_type AS tic, ts AS date, value AS close, event_id FROM events""",
    doubles="close", dates="date",
)
def b1(spark, folder):
    raw = I.table(spark, folder, "events").select(
        F.col("event_type").alias("Symbol"), F.col("ts").alias("Time"), F.col("value").alias("Adj Close"), "event_id"
    )
    return X.canon_columns(raw)


@query(
    "b2_date_timestamp_swap",
    f"""WITH {S.BARS_DAILY} -- result
    SELECT date, tic, close, CAST(month(date) AS BIGINT) AS month FROM bars""",
    doubles="close", dates="date",
)
def b2(spark, folder):
    bars = I.bars_daily(spark, folder).select("date", "tic", "close")
    return X.date_timestamp_swap(bars, lambda d: d.withColumn("month", F.month("timestamp").cast("long")))


@query("b3_require_columns", f"WITH {S.BARS_DAILY} -- result\n SELECT * FROM bars", doubles=S.OHLC, dates="date")
def b3(spark, folder):
    return X.require_columns(I.bars_daily(spark, folder), ["tic", "date", *OHLCV])


@query(
    "b4_validate_schema",
    """-- result
    SELECT CAST(0 AS BIGINT) AS schema_errors, count(*) FILTER (NOT (value BETWEEN 0.5 AND 100)) AS value_out_of_range,
      count(*) FILTER (NOT (user_id BETWEEN 1 AND 100)) AS user_id_out_of_range FROM events""",
)
def b4(spark, folder):
    return X.validate_schema(
        I.table(spark, folder, "events"), {"value": "double", "user_id": "bigint", "ts": "timestamp_ntz"},
        {"value": (0.5, 100.0), "user_id": (1, 100)},
    )


@query(
    "b5_add_missing_null_cols",
    f"""WITH {S.BARS_DAILY} -- result
    SELECT date, tic, close, CAST(NULL AS DOUBLE) AS vix, CAST(NULL AS VARCHAR) AS note FROM bars""",
    doubles="close", dates="date",
)
def b5(spark, folder):
    schema = T.StructType.fromDDL("date date, tic string, close double, vix double, note string")
    return X.add_missing_null_columns(I.bars_daily(spark, folder), schema)


@query(
    "b6_available_features",
    f"WITH {S.BARS_DAILY} -- result\n SELECT date, tic, close, volume FROM bars", doubles="close", dates="date",
)
def b6(spark, folder):
    return X.available_features(I.bars_daily(spark, folder), ["close", "macd", "volume", "rsi_30"])


@query(
    "b7_parse_ts_coerce",
    """WITH t AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'not a time' ELSE CAST(ts AS VARCHAR) END AS raw FROM events)
    -- result
    SELECT event_id, TRY_CAST(raw AS TIMESTAMP) AS published_at FROM t""",
    dates="published_at",
)
def b7(spark, folder):
    raw = F.when(F.col("event_type") == "error", F.lit("not a time")).otherwise(F.col("ts").cast("string"))
    return I.table(spark, folder, "events").select("event_id", raw.try_cast("timestamp_ntz").alias("published_at"))


@query("b8_to_date", "-- result\n SELECT event_id, CAST(ts AS DATE) AS date FROM events", dates="date")
def b8(spark, folder):
    return I.table(spark, folder, "events").select("event_id", F.to_date("ts").alias("date"))


NULLED = """nulled AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS published_at,
  CASE WHEN value < 5 THEN NULL ELSE props END AS headline FROM events)"""


def _nulled(spark, folder):
    return I.table(spark, folder, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("ts")).alias("published_at"),
        F.when(F.col("value") >= 5, F.col("props")).alias("headline"),
    )


@query(
    "b9_drop_null_critical",
    f"WITH {NULLED} -- result\n SELECT * FROM nulled WHERE published_at IS NOT NULL AND headline IS NOT NULL",
    dates="published_at",
)
def b9(spark, folder):
    return X.drop_null_critical(_nulled(spark, folder))


@query(
    "b10_drop_all_null_ohlcv",
    f"WITH {NULLED} -- result\n SELECT * FROM nulled WHERE published_at IS NOT NULL OR headline IS NOT NULL",
    dates="published_at",
)
def b10(spark, folder):
    return X.drop_all_null(_nulled(spark, folder), ["published_at", "headline"])


@query(
    "b11_range_half_open",
    """-- result
    SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
      WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01'""",
    dates="l_shipdate",
)
def b11(spark, folder):
    line = I.table(spark, folder, "lineitem").select("l_orderkey", F.col("l_linenumber"), "l_shipdate")
    lo, hi = (F.lit(d).cast("timestamp_ntz") for d in ("1996-01-01", "1997-01-01"))
    return X.half_open(line, lo, hi, "l_shipdate")


@query(
    "b12_range_closed_day",
    """-- result
    SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-11'""",
    dates="ts",
)
def b12(spark, folder):
    return X.closed_days(I.table(spark, folder, "events").select("event_id", "ts"), "2024-01-05", "2024-01-10", "ts")


@query(
    "b13_lookback_window",
    f"""WITH {S.BARS_DAILY} -- result
    SELECT * FROM bars WHERE date BETWEEN DATE '2024-01-13' AND DATE '2024-01-20'""",
    doubles=S.OHLC, dates="date",
)
def b13(spark, folder):
    return X.lookback(I.bars_daily(spark, folder), "2024-01-20", 7)


@query(
    "b14_first_nonempty_text",
    f"""WITH {S.NEWS} -- result
    SELECT id, coalesce(nullif(CASE WHEN lang = 'fr' THEN '' ELSE headline END, ''), nullif(CASE WHEN lang = 'fr' THEN summary END, ''), '') AS text FROM news""",
)
def b14(spark, folder):
    from tickloom.functions.text import first_nonempty

    french = F.col("lang") == "fr"
    return I.news(spark, folder).select(
        "id",
        first_nonempty(F.when(french, F.lit("")).otherwise(F.col("headline")), F.when(french, F.col("summary"))).alias("text"),
    )


@query(
    "b15_concat_text",
    f"""WITH {S.NEWS}, h AS (SELECT id, CASE WHEN lang = 'de' THEN NULL ELSE headline END AS h,
      CASE WHEN lang = 'fr' THEN '' ELSE source_name END AS d FROM news)
    -- result
    SELECT id, CASE WHEN coalesce(h, '') <> '' AND coalesce(d, '') <> '' THEN h || '. ' || d
      WHEN coalesce(h, '') <> '' THEN h ELSE coalesce(d, '') END AS text FROM h""",
)
def b15(spark, folder):
    from tickloom.functions.text import concat_text

    h = F.when(F.col("lang") != "de", F.col("headline"))
    d = F.when(F.col("lang") == "fr", F.lit("")).otherwise(F.col("source_name"))
    return I.news(spark, folder).select("id", concat_text(h, d).alias("text"))


@query(
    "b16_choose_text_column",
    f"""WITH {S.NEWS} -- result
    SELECT id, summary AS a, headline AS b FROM news""",
)
def b16(spark, folder):
    news = I.news(spark, folder).withColumn("full_text", F.lit(None).cast("string"))
    with_a = X.choose_text_column(news, "full_text", "summary", "a")
    return X.choose_text_column(with_a, "headline", "summary", "b").select("id", "a", "b")


@query(
    "b17_ticker_universe",
    """-- result
    SELECT DISTINCT tic FROM (SELECT p_brand AS tic FROM part UNION ALL SELECT event_type FROM events)""",
)
def b17(spark, folder):
    a = I.table(spark, folder, "part").select(F.col("p_brand").alias("tic"))
    return X.ticker_universe(a, I.ticks(spark, folder)).orderBy("tic")


@query(
    "b18_filter_ticker",
    "-- result\n SELECT event_id, ts, value FROM events WHERE event_type = 'purchase'", doubles="value", dates="ts",
)
def b18(spark, folder):
    return I.ticks(spark, folder).filter("tic = 'purchase'").select("event_id", "ts", "value")


@query("b19_select_numeric", "-- result\n SELECT event_id, user_id, value FROM events", doubles="value")
def b19(spark, folder):
    return X.select_numeric(I.table(spark, folder, "events"))


@query(
    "b20_corr_column_pick",
    f"WITH {S.BARS_DAILY} -- result\n SELECT open, high, low, close, volume FROM bars", doubles=S.OHLC,
)
def b20(spark, folder):
    bars = I.bars_daily(spark, folder)
    wide = bars.withColumns({f"extra_{i}": F.col("close") for i in range(12)})
    return wide.select(*X.pick_columns(X.numeric_columns(wide)))


@query("b21_enabled_switch", f"WITH {S.BARS_DAILY} -- result\n SELECT *, 1 AS kept FROM bars", doubles=S.OHLC, dates="date")
def b21(spark, folder):
    bars = X.step_if(False, I.bars_daily(spark, folder), lambda d: d.filter("1 = 0"))
    return X.step_if(True, bars, lambda d: d.withColumn("kept", F.lit(1)))


@query(
    "b22_all_null_column_check",
    """-- result
    SELECT count(props) = 0 AS props, true AS vix, count(CASE WHEN value < 0 THEN value END) = 0 AS below_zero FROM events""",
)
def b22(spark, folder):
    events = I.table(spark, folder, "events").withColumn("below_zero", F.when(F.col("value") < 0, F.col("value")))
    return X.all_null_check(events, ["props", "vix", "below_zero"])


@query(
    "b23_fill_missing_features_zero",
    f"WITH {S.BARS_DAILY} -- result\n SELECT *, CAST(0 AS DOUBLE) AS macd, CAST(0 AS DOUBLE) AS rsi_30 FROM bars",
    doubles=S.OHLC, dates="date",
)
def b23(spark, folder):
    return X.fill_missing_features(I.bars_daily(spark, folder), ["close", "macd", "rsi_30"])


@query(
    "b24_parse_date_like",
    """-- result
    SELECT event_id, ts AS good_parsed, CAST(NULL AS TIMESTAMP) AS bad_parsed FROM events""",
    dates="good_parsed bad_parsed",
)
def b24(spark, folder):
    raw = I.table(spark, folder, "events").select(
        "event_id", F.col("ts").cast("string").alias("good"),
        F.when(F.col("event_type") == "view", F.lit("n/a")).otherwise(F.col("ts").cast("string")).alias("bad"),
    )
    both = X.parse_date_like(X.parse_date_like(raw, "good"), "bad")
    return both.select("event_id", "good_parsed", "bad_parsed")


@query("s1_sort_news_desc", f"WITH {S.NEWS} -- result\n SELECT id, published_at, headline FROM news ORDER BY published_at DESC, id",
       dates="published_at")
def s1(spark, folder):
    return I.news(spark, folder).select("id", "published_at", "headline").orderBy(F.desc("published_at"), "id")


@query("s2_sort_date_tic", f"WITH {S.BARS_HOURLY} -- result\n SELECT date, tic, close FROM bars ORDER BY date, tic",
       doubles="close", dates="date")
def s2(spark, folder):
    return I.bars_hourly(spark, folder).select("date", "tic", "close").orderBy("date", "tic")


@query("s2_sort_tic_date", f"WITH {S.BARS_HOURLY} -- result\n SELECT date, tic, close FROM bars ORDER BY tic, date",
       doubles="close", dates="date")
def s2b(spark, folder):
    return I.bars_hourly(spark, folder).select("date", "tic", "close").orderBy("tic", "date")


@query(
    "s3_head_tail",
    """WITH h AS (SELECT 'head' AS part, * FROM events ORDER BY ts, event_id LIMIT 5), t AS (SELECT 'tail' AS part, * FROM events ORDER BY ts DESC, event_id DESC LIMIT 5)
    -- result
    SELECT * FROM h UNION ALL SELECT * FROM t""",
    doubles="value", dates="ts",
)
def s3(spark, folder):
    """First and last five ticks: a preview, so the limit is the feature."""
    events = I.table(spark, folder, "events")
    first = X.head(events, 5, F.asc("ts"), F.asc("event_id")).withColumn("part", F.lit("head"))
    last = X.head(events, 5, F.desc("ts"), F.desc("event_id")).withColumn("part", F.lit("tail"))
    return first.unionByName(last)


@query(
    "s4_page_cap",
    """-- result
    SELECT event_type AS query, event_id, CAST(row_number() OVER w AS INTEGER) AS rank FROM events
      WINDOW w AS (PARTITION BY event_type ORDER BY ts DESC, event_id) QUALIFY row_number() OVER w <= 100""",
)
def s4(spark, folder):
    """The 100 newest entries of each query, as a news page holds."""
    events = I.table(spark, folder, "events").select(F.col("event_type").alias("query"), "event_id", "ts")
    return X.newest_per_query(events, "query", 100, [F.desc("ts"), F.asc("event_id")]).drop("ts")


@query(
    "u1_union_sources",
    """-- result
    SELECT doc_id AS id, text, 'documents' AS origin, source, CAST(NULL AS VARCHAR) AS url FROM documents
      UNION ALL SELECT page_id, html, 'pages', NULL, url FROM pages""",
)
def u1(spark, folder):
    docs = I.table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text", F.lit("documents").alias("origin"), "source")
    pages = I.table(spark, folder, "pages").select(F.col("page_id").alias("id"), F.col("html").alias("text"), F.lit("pages").alias("origin"), "url")
    return X.union_sources([docs, pages])


@query("u2_union_distinct", "-- result\n SELECT c_mktsegment AS tic FROM customer UNION SELECT o_orderpriority FROM orders")
def u2(spark, folder):
    a = I.table(spark, folder, "customer").select(F.col("c_mktsegment").alias("tic"))
    b = I.table(spark, folder, "orders").select(F.col("o_orderpriority").alias("tic"))
    return X.ticker_universe(a, b)


@query("u3_column_intersection", "-- result\n SELECT doc_id FROM documents")
def u3(spark, folder):
    docs = I.table(spark, folder, "documents")
    return docs.select(*X.column_sets(docs, I.table(spark, folder, "labels"))["common"])


@query(
    "u4_train_val_split",
    """-- result
    SELECT doc_id, CASE WHEN ('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT < 429496729 THEN 'validation' ELSE 'train' END AS part FROM documents""",
)
def u4(spark, folder):
    return I.table(spark, folder, "documents").select("doc_id", X.split_column(0.1, 42, "doc_id").alias("part"))


@query(
    "u5_date_split",
    f"""WITH {S.BARS_LONG} -- result
    SELECT date, tic, volume, 'train' AS part FROM bars WHERE date >= DATE '1996-01-01' AND date < DATE '1999-01-01'
      UNION ALL SELECT date, tic, volume, 'trade' FROM bars WHERE date >= DATE '1999-01-01' AND date < DATE '2000-07-01'""",
    doubles="volume", dates="date",
)
def u5(spark, folder):
    bars = I.bars_long(spark, folder).select("date", "tic", "volume")
    return X.date_split(bars, ("1996-01-01", "1999-01-01"), ("1999-01-01", "2000-07-01"))


@query(
    "u6_walk_forward_folds",
    f"""WITH {S.BARS_LONG}, folds AS (SELECT CAST(f AS BIGINT) AS fold, DATE '1995-01-02' + CAST(f * 180 AS INTEGER) AS s FROM range(10) t(f))
    -- result
    SELECT date, tic, volume, fold, CASE WHEN date < s + 720 THEN 'train' ELSE 'test' END AS part
      FROM bars JOIN folds ON date >= s AND date < s + 900""",
    doubles="volume", dates="date",
)
def u6(spark, folder):
    bars = I.bars_long(spark, folder).select("date", "tic", "volume")
    return X.walk_forward_folds(bars, "1995-01-02", 10, 720, 180, 180)
