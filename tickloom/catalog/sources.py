"""Queries: readers, payload normalisers and writers. Files are written from the given tables first."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schemas as SC
from tickloom.catalog import sql as S
from tickloom.catalog.registry import query
from tickloom.functions import text as X
from tickloom.operators import frames as FR
from tickloom.plans import inputs as I
from tickloom.session import scratch_path
from tickloom.sources import normalize as N
from tickloom.sources import readers as R
from tickloom.sources import runs as RU
from tickloom.sources import sinks as W

DAILY = f"WITH {S.BARS_DAILY} -- result\n SELECT date, tic, open, high, low, close, CAST(volume AS DOUBLE) AS volume FROM bars"


def bars(spark, folder):
    return I.bars_daily(spark, folder).select(
        "date", "tic", "open", "high", "low", "close", F.col("volume").cast("double").alias("volume")
    )


@query("scan_csv", DAILY, doubles=f"{S.OHLC} volume", dates="date")
def scan_csv(spark, folder):
    return R.scan_csv(spark, W.sink_csv(bars(spark, folder), scratch_path(spark, "csv")), SC.BARS)


@query("scan_csv_corrupt", "-- result\n SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value, event_type = 'error' AS corrupt FROM events", doubles="value")
def scan_csv_corrupt(spark, folder):
    """Values of error events are written as text; the reader gives NULL and keeps the line."""
    shown = F.when(F.col("event_type") == "error", F.lit("none")).otherwise(F.col("value").cast("string"))
    path = W.sink_csv(I.table(spark, folder, "events").select("event_id", shown.alias("value")), scratch_path(spark, "csv"))
    read = R.scan_csv(spark, path, T.StructType.fromDDL("event_id bigint, value double"), keep_corrupt=True)
    return read.select("event_id", "value", F.col(R.CORRUPT).isNotNull().alias("corrupt"))


@query("scan_parquet", "-- result\n SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_totalprice > 200000", doubles="o_totalprice", dates="o_orderdate")
def scan_parquet(spark, folder):
    schema = T.StructType.fromDDL("o_orderkey bigint, o_orderdate timestamp_ntz, o_totalprice double")
    return R.scan_parquet(spark, f"{folder}/orders.parquet", schema).filter("o_totalprice > 200000")


@query("scan_json_array", "-- result\n SELECT conv_id, turn, role, text FROM conversations")
def scan_json_array(spark, folder):
    """One file per conversation, holding the list of its turns."""
    turns = I.table(spark, folder, "conversations")
    entry = F.struct("conv_id", "turn", "role", "text")
    lists = turns.groupBy("conv_id").agg(F.to_json(F.collect_list(entry)).alias("value"))
    path = scratch_path(spark, "arrays")
    lists.write.partitionBy("conv_id").text(path)
    schema = T.StructType.fromDDL("conv_id bigint, turn bigint, role string, text string")
    return R.scan_json_array(spark, f"{path}/conv_id=*", schema)


@query("scan_jsonl", "-- result\n SELECT doc_id, text, lang, source, n_chars FROM documents")
def scan_jsonl(spark, folder):
    docs = I.table(spark, folder, "documents")
    return R.scan_jsonl(spark, W.sink_jsonl(docs, scratch_path(spark, "jsonl")), docs.schema)


@query("scan_text_whole", "-- result\n SELECT item_id, rtrim(text, chr(10)) AS text FROM benchmark WHERE regexp_matches(text, '\\S')")
def scan_text_whole(spark, folder):
    path = scratch_path(spark, "texts")
    I.table(spark, folder, "benchmark").select("item_id", F.col("text").alias("value")).write.partitionBy("item_id").text(path)
    read = R.scan_text_files(spark, f"{path}/item_id=*")
    item = F.regexp_extract("path", r"item_id=(\d+)", 1).cast("long")
    return read.select(item.alias("item_id"), F.regexp_replace("text", r"\n+$", "").alias("text"))


@query("scan_date_partition", f"WITH {S.BARS_DAILY} -- result\n SELECT date, tic, close FROM bars WHERE date = DATE '2024-01-10'", doubles="close", dates="date")
def scan_date_partition(spark, folder):
    path = W.sink_by_date(bars(spark, folder), scratch_path(spark, "days"))
    return R.scan_date_partition(spark, path, "2024-01-10").select("date", "tic", "close")


@query("scan_latest_snapshot", f"WITH {S.BARS_DAILY} -- result\n SELECT date, tic, close FROM bars WHERE tic <> 'view'", doubles="close", dates="date")
def scan_latest_snapshot(spark, folder):
    """The newest run broke off before it was listed, so the one before it is read."""
    path = scratch_path(spark, "runs")
    RU.publish_run(bars(spark, folder), path, "20240101_000000")
    RU.publish_run(bars(spark, folder).filter("tic <> 'view'"), path, "20240102_000000")
    bars(spark, folder).filter("tic = 'view'").write.parquet(f"{path}/rows/part=broken")
    return RU.scan_newest_run(spark, path).select("date", "tic", "close")


@query("scan_run_list", f"WITH {S.BARS_DAILY} -- result\n SELECT CASE tic WHEN 'view' THEN '20240101_000000' ELSE '20240102_000000' END AS run, CAST(0 AS BIGINT) AS attempt, count(*) AS n_rows FROM bars GROUP BY ALL")
def scan_run_list(spark, folder):
    """Rows of each finished run, counted while it was written; a run without rows and one that broke off are not listed."""
    path = scratch_path(spark, "runs")
    RU.publish_run(bars(spark, folder).filter("tic = 'view'"), path, "20240101_000000")
    RU.publish_run(bars(spark, folder).filter("tic <> 'view'"), path, "20240102_000000")
    RU.publish_run(bars(spark, folder).filter("close < 0"), path, "20240103_000000", skip_empty=True)
    bars(spark, folder).write.parquet(f"{path}/rows/part=broken")
    return RU.list_runs(spark, path)


@query(
    "scan_presplit",
    """-- result
    SELECT doc_id, text, CASE WHEN lang = 'en' THEN 'train' ELSE 'test' END AS part, 'folders' AS origin FROM documents
      UNION ALL SELECT doc_id, text, CASE WHEN ('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT < 858993459 THEN 'test' ELSE 'train' END, 'split' FROM documents""",
)
def scan_presplit(spark, folder):
    docs = I.table(spark, folder, "documents").select("doc_id", "text", "lang")
    base, single = scratch_path(spark, "presplit"), scratch_path(spark, "single")
    W.sink_jsonl(docs.filter("lang = 'en'"), f"{base}/train")
    W.sink_jsonl(docs.filter("lang <> 'en'"), f"{base}/test")
    W.sink_jsonl(docs, single)

    def split(df):
        return FR.train_validation_split(df, 0.2, 42, "doc_id")

    out = []
    for origin, path in (("folders", base), ("split", single)):
        for part, df in zip(("train", "test"), R.scan_presplit(spark, path, docs.schema, split)):
            out.append(df.select("doc_id", "text", F.lit(part).alias("part"), F.lit(origin).alias("origin")))
    return FR.union_sources(out)


@query(
    "scan_multi_source_union",
    """-- result
    SELECT ts AS timestamp, event_type AS ticker, value, CAST(NULL AS DOUBLE) AS total FROM events
      UNION ALL SELECT o_orderdate, o_orderpriority, NULL, o_totalprice FROM orders""",
    doubles="value total", dates="timestamp",
)
def scan_multi_source_union(spark, folder):
    """A disabled source and one whose path is missing, which is allowed, are left out."""
    return R.scan_sources(spark, _sources(spark, folder), ["timestamp", "ticker"], allowed=["missing"])


def _sources(spark, folder):
    return [
        {"name": "events", "enabled": True, "read": lambda: I.table(spark, folder, "events").select(
            F.col("ts").alias("timestamp"), F.col("event_type").alias("ticker"), "value")},
        {"name": "orders", "enabled": True, "read": lambda: I.table(spark, folder, "orders").select(
            F.col("o_orderdate").alias("timestamp"), F.col("o_orderpriority").alias("ticker"), F.col("o_totalprice").alias("total"))},
        {"name": "off", "enabled": False, "read": lambda: I.table(spark, folder, "lineitem")},
        {"name": "missing", "enabled": True, "read": lambda: I.table(spark, folder, "no_such_table")},
    ]


@query(
    "scan_source_report",
    """-- result
    SELECT 'events' AS source, count(*) AS n_rows, CAST(NULL AS VARCHAR) AS reason FROM events UNION ALL SELECT 'orders', count(*), NULL FROM orders
      UNION ALL SELECT 'off', 0, 'disabled' UNION ALL SELECT 'missing', 0, 'PATH_NOT_FOUND'""",
)
def scan_source_report(spark, folder):
    """Rows of each source that was read, and the reason of each that was left out."""
    both, left_out = R.read_sources(spark, _sources(spark, folder))
    read = both.groupBy(F.col("source_table").alias("source")).agg(F.count("*").alias("n_rows"))
    return read.unionByName(left_out.withColumn("n_rows", F.lit(0).cast("bigint")), allowMissingColumns=True)


def _primary(spark, folder):
    news = I.news(spark, folder)
    time = F.when(F.col("lang") == "fr", F.lit("soon")).otherwise(F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    article = F.struct(
        time.alias("publishedAt"), F.struct(F.col("source_name").alias("name")).alias("source"),
        F.col("headline").alias("title"), F.col("summary").alias("description"), F.col("id").cast("string").alias("url"),
    )
    return news.select(F.to_json(article).alias("raw"))


def _seconds(news):
    return news.withColumn("seconds", F.unix_seconds("published_at")).drop("published_at", "raw_data")


@query(
    "normalize_news_primary",
    f"""WITH {S.NEWS} -- result
    SELECT CASE WHEN lang <> 'fr' THEN CAST(epoch(published_at) AS VARCHAR) END AS seconds, source_name, headline, summary AS description, 'primary' AS api_source, CAST(id AS VARCHAR) AS url FROM news""".replace(
        "CAST(epoch(published_at) AS VARCHAR)", "CAST(CAST(epoch(published_at) AS BIGINT) AS VARCHAR)"),
)
def normalize_primary(spark, folder):
    out = _seconds(N.primary_news(_primary(spark, folder)))
    return out.withColumn("seconds", F.col("seconds").cast("string"))


def _secondary(spark, folder):
    news = I.news(spark, folder)
    seconds = F.datediff("published_at", F.lit("1970-01-01").cast("date")).cast("long") * 86400
    article = F.struct(
        seconds.alias("datetime"), F.col("source_name").alias("source"), "headline", "summary",
        F.col("id").cast("string").alias("url"), "id",
    )
    return news.select(F.to_json(article).alias("raw"))


SECONDARY = f"""WITH {S.NEWS} -- result
    SELECT CAST(epoch(published_at) AS BIGINT) AS seconds, source_name, headline, summary AS description, 'secondary' AS api_source, CAST(id AS VARCHAR) AS url
      FROM news WHERE published_at >= TIMESTAMP '2024-01-03' AND published_at < TIMESTAMP '2024-01-21'"""


@query("normalize_news_secondary", SECONDARY)
def normalize_secondary(spark, folder):
    return _seconds(N.secondary_news(_secondary(spark, folder), "2024-01-03", "2024-01-20"))


@query("fallback_source", SECONDARY)
def fallback_source(spark, folder):
    """The primary source has no rows, so the secondary one is read."""
    primary = N.primary_news(_primary(spark, folder).filter("raw IS NULL"))
    secondary = N.secondary_news(_secondary(spark, folder), "2024-01-03", "2024-01-20")
    return _seconds(R.fallback_source(primary, secondary))


@query("sink_csv", f"WITH {S.BARS_HOURLY} -- result\n SELECT tic, close, volume FROM bars", doubles="close")
def sink_csv(spark, folder):
    df = I.bars_hourly(spark, folder).select("tic", "close", "volume")
    return R.scan_csv(spark, W.sink_csv(df, scratch_path(spark, "csv")), df.schema)


@query("sink_parquet_if_nonempty", f"WITH {S.BARS_DAILY} -- result\n SELECT date, tic, close, true AS full_written, false AS empty_written FROM bars", doubles="close", dates="date")
def sink_nonempty(spark, folder):
    df, path = bars(spark, folder).select("date", "tic", "close"), scratch_path(spark, "some")
    wrote = W.sink_parquet_if_nonempty(df, path)
    empty = W.sink_parquet_if_nonempty(df.filter("close < 0"), scratch_path(spark, "none"))
    return R.scan_parquet(spark, path).withColumns({"full_written": F.lit(wrote), "empty_written": F.lit(empty)})


@query(
    "sink_empty_with_header",
    f"""WITH {S.BARS_DAILY} -- result
    SELECT 'empty' AS part, 'date,tic,volume' AS line, true AS header UNION ALL SELECT 'full', 'date,tic,volume', true
      UNION ALL SELECT 'full', CAST(date AS VARCHAR) || ',' || tic || ',' || volume, false FROM bars""",
)
def sink_empty(spark, folder):
    """Lines of the files written for no rows and for all rows."""
    df, out = I.bars_daily(spark, folder).select("date", "tic", "volume"), []
    for name, rows in (("empty", df.filter("close < 0")), ("full", df)):
        path = W.sink_csv_with_header(rows, scratch_path(spark, "header"))
        lines = spark.read.text(path).select(F.lit(name).alias("part"), F.col("value").alias("line"))
        is_header = F.col("line").startswith("date,")
        marked = lines.withColumn("header", is_header)
        out += [marked.where("header").distinct(), marked.where("not header")]
    return FR.union_sources(out)


@query("sink_jsonl", f"WITH d AS (SELECT doc_id, text, lower(text) AS t FROM documents) -- result\n SELECT doc_id, text AS input, {S.label('t')} AS output FROM d")
def sink_jsonl(spark, folder):
    rows = I.table(spark, folder, "documents").select(
        "doc_id", F.col("text").alias("input"), X.keyword_label("text", I.POSITIVE, I.NEGATIVE).alias("output")
    )
    return R.scan_jsonl(spark, W.sink_jsonl(rows, scratch_path(spark, "jsonl")), rows.schema)


@query("sink_by_date", DAILY, doubles=f"{S.OHLC} volume", dates="date")
def sink_by_date(spark, folder):
    path = W.sink_by_date(bars(spark, folder), scratch_path(spark, "days"))
    return R.scan_parquet(spark, path, SC.BARS)


@query("sink_by_tic", f"WITH {S.BARS_DAILY} -- result\n SELECT date, tic || '_x' AS tic, close FROM bars", doubles="close", dates="date")
def sink_by_tic(spark, folder):
    raw = bars(spark, folder).select("date", F.concat(F.lit("^"), "tic", F.lit("/x")).alias("tic"), "close")
    path = W.sink_by_date(raw, scratch_path(spark, "tics"), by_ticker=True)
    return R.scan_parquet(spark, path, raw.schema)


@query(
    "sink_article_path",
    rf"""WITH {S.NEWS} -- result
    SELECT id, source_name || '_' || strftime(published_at, '%Y%m%dT%H%M%S') || '_' ||
      coalesce(nullif(replace(trim(substr(regexp_replace(headline, '[^\p{{L}}\p{{N}} _]', '_', 'g'), 1, 50)), ' ', '_'), ''), 'article') || '_' || id AS article_key FROM news""",
)
def article_path(spark, folder):
    return I.news(spark, folder).select("id", X.article_key("source_name", "published_at", "headline", "id").alias("article_key"))


@query("sink_run_stamped", f"WITH {S.BARS_DAILY} -- result\n SELECT date, tic, close, r AS run_ts FROM bars, (VALUES ('20240101_000000'), ('20240102_000000')) v(r)", doubles="close", dates="date")
def sink_run(spark, folder):
    path = scratch_path(spark, "runs")
    for run in ("20240101_000000", "20240102_000000"):
        W.sink_run_stamped(bars(spark, folder).select("date", "tic", "close"), path, run)
    return spark.read.parquet(path)


@query(
    "sink_multi_output",
    f"""WITH {S.NEWS}, {S.CLEANED}, {S.LABELLED} -- result
    SELECT id, processed_text, CAST(NULL AS VARCHAR) AS label FROM labelled UNION ALL SELECT id, NULL, label FROM labelled WHERE label <> 'neutral'""",
)
def multi_output(spark, folder):
    texts, labels = scratch_path(spark, "texts"), scratch_path(spark, "labels")
    W.sink_outputs(I.labelled_news(spark, folder), {
        "texts": (texts, None, ["id", "processed_text"]),
        "labels": (labels, F.col("label") != "neutral", ["id", "label"]),
    })
    return FR.union_sources([spark.read.parquet(texts), spark.read.parquet(labels)])


def _payloads(spark, folder):
    """Articles of both kinds; French ones of the second kind give their time as text, German ones carry a field more."""
    news = I.news(spark, folder)
    name, odd = F.col("source_name"), F.col("id") % 2 == 1
    seconds = F.datediff("published_at", F.lit("1970-01-01").cast("date")).cast("long") * 86400
    first = F.to_json(F.struct(
        F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"), F.struct(name.alias("name")).alias("source"),
        F.col("headline").alias("title"), F.col("summary").alias("description"), F.col("id").cast("string").alias("url")))
    rest = (name.alias("source"), "headline", "summary", F.col("id").cast("string").alias("url"))
    second = (
        F.when(F.col("lang") == "fr", F.to_json(F.struct(F.lit("soon").alias("datetime"), *rest)))
        .when(F.col("lang") == "de", F.to_json(F.struct(seconds.alias("datetime"), *rest, (F.col("id") % 2 == 1).alias("paid"))))
        .otherwise(F.to_json(F.struct(seconds.alias("datetime"), *rest))))
    return news.select(F.when(odd, second).otherwise(first).alias("raw"))


@query(
    "t20_any_payload",
    f"""WITH {S.NEWS} -- result
    SELECT CASE WHEN id % 2 = 0 OR lang <> 'fr' THEN CAST(CAST(epoch(published_at) AS BIGINT) AS VARCHAR) END AS seconds, source_name, headline, summary AS description,
      CASE id % 2 WHEN 0 THEN 'primary' ELSE 'secondary' END AS api_source, CAST(id AS VARCHAR) AS url,
      CASE WHEN id % 2 = 1 AND lang = 'de' THEN 'true' END AS paid FROM news""",
)
def t20_any_payload(spark, folder):
    """Both kinds through one reader; a time given as text is NULL, an unknown field stays in the payload."""
    read = N.any_news(_payloads(spark, folder))
    paid = F.try_variant_get("payload", "$.paid", "boolean").cast("string")
    out = _seconds(read.withColumn("paid", paid)).drop("payload")
    return out.withColumn("seconds", F.col("seconds").cast("string"))


@query(
    "t20_changed_fields",
    f"""WITH {S.NEWS}, k AS (SELECT id, lang FROM news WHERE id % 2 = 1) -- result
    SELECT 'secondary' AS api_source, 'datetime' AS field, 'BIGINT' AS expected, 'STRING' AS type, count(*) AS n FROM k WHERE lang = 'fr' HAVING count(*) > 0
      UNION ALL SELECT 'secondary', 'paid', NULL, 'BOOLEAN', count(*) FROM k WHERE lang = 'de' HAVING count(*) > 0""",
)
def t20_changed_fields(spark, folder):
    """Fields whose type changed, and unknown ones."""
    text = dict.fromkeys(("headline", "summary", "source", "url"), "STRING")
    stated = {
        "primary": dict.fromkeys(("publishedAt", "title", "description", "url"), "STRING") | {"source": "OBJECT"},
        "secondary": text | {"datetime": "BIGINT"},
    }
    return N.changed_fields(N.payload_fields(N.any_news(_payloads(spark, folder))), stated)


@query(
    "canonical_news",
    f"""WITH {S.NEWS} -- result
    SELECT CAST(epoch(published_at) AS BIGINT) AS seconds, source_name, headline, summary AS description, 'primary' AS api_source, CAST(id AS VARCHAR) AS url FROM news WHERE lang <> 'fr'""",
)
def canonical(spark, folder):
    return _seconds(N.canonical_news(N.primary_news(_primary(spark, folder))))
