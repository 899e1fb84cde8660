"""Queries: text cleaning, labels, instruction rows and scoring."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tickloom.catalog import sql as S
from tickloom.catalog.registry import query
from tickloom.functions import labels as L
from tickloom.functions import text as X
from tickloom.functions.constants import FEATURE_PROMPT_TEMPLATE, PROMPT_TEMPLATE
from tickloom.operators import curation as C
from tickloom.operators import keywords as KW
from tickloom.operators import scoring as SC
from tickloom.plans import inputs as I
from tickloom.sources.normalize import nested_source


def docs(spark, folder):
    return I.documents(spark, folder)


@query("t1_remove_html", f"-- result\n SELECT page_id, {S.no_html('html')} AS text FROM pages")
def t1(spark, folder):
    return I.table(spark, folder, "pages").select("page_id", X.remove_html("html").alias("text"))


@query("t2_remove_urls", f"-- result\n SELECT page_id, {S.no_urls('html')} AS text, {S.no_urls('url')} AS url FROM pages")
def t2(spark, folder):
    return I.table(spark, folder, "pages").select("page_id", X.remove_urls("html").alias("text"), X.remove_urls("url").alias("url"))


@query("t3_lowercase", "-- result\n SELECT doc_id, lower(text) AS text FROM documents")
def t3(spark, folder):
    return docs(spark, folder).select("doc_id", X.lowercase("text").alias("text"))


@query("t4_remove_punctuation", f"-- result\n SELECT doc_id, {S.no_punctuation('text')} AS text FROM documents")
def t4(spark, folder):
    return docs(spark, folder).select("doc_id", X.remove_punctuation("text").alias("text"))


@query("t5_remove_stopwords", f"-- result\n SELECT doc_id, {S.no_stopwords('text')} AS text FROM documents")
def t5(spark, folder):
    return docs(spark, folder).select("doc_id", X.remove_stopwords("text").alias("text"))


@query("t6_process_text", f"-- result\n SELECT doc_id, {S.processed('text')} AS text FROM documents")
def t6(spark, folder):
    return docs(spark, folder).select("doc_id", X.process_text("text").alias("text"))


@query(
    "t6_process_pages",
    f"-- result\n SELECT page_id, {S.processed('html')} AS html_processed, {S.processed('url')} AS url_processed FROM pages",
)
def t6_pages(spark, folder):
    pages = X.process_columns(I.table(spark, folder, "pages"), ["html", "url"])
    return pages.select("page_id", "html_processed", "url_processed")


@query("t7_process_texts", f"-- result\n SELECT conv_id, turn, {S.processed('text')} AS text_processed FROM conversations")
def t7(spark, folder):
    return X.process_columns(I.table(spark, folder, "conversations"), ["text"]).select("conv_id", "turn", "text_processed")


@query("t8_keyword_label", f"WITH d AS (SELECT doc_id, lower(text) AS t FROM documents) -- result\n SELECT doc_id, {S.label('t')} AS label FROM d")
def t8(spark, folder):
    return docs(spark, folder).select("doc_id", X.keyword_label("text", I.POSITIVE, I.NEGATIVE).alias("label"))


def _prompt_sql(template: str, hole: str, column: str) -> str:
    before, after = template.split("{" + hole + "}")
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    return f"{quote(before)} || {column} || {quote(after)}"


@query(
    "t8_keyword_index",
    r"""WITH d AS (SELECT doc_id, string_split(lower(text), ' ') AS p FROM documents),
    k AS (SELECT lower(regexp_extract(text, '[^ \n]+ [^ \n]+')) AS keyword, doc_id % 2 = 0 AS positive FROM documents),
    kinds AS (SELECT keyword, min(positive) AS positive FROM k WHERE regexp_matches(keyword, '^[a-z]+ [a-z]+$') GROUP BY keyword),
    pairs AS (SELECT DISTINCT doc_id, regexp_extract(p[i], '([\p{L}\p{N}_]+)$', 1) || ' ' || regexp_extract(p[i + 1], '^([\p{L}\p{N}_]+)', 1) AS keyword
      FROM d, unnest(range(1, len(p))) AS u(i)),
    hits AS (SELECT doc_id, positive, count(*) AS n FROM pairs JOIN kinds USING (keyword) GROUP BY ALL)
    -- result
    SELECT doc_id, coalesce(sum(n) FILTER (positive), 0)::BIGINT AS positive, coalesce(sum(n) FILTER (NOT positive), 0)::BIGINT AS negative FROM hits GROUP BY doc_id""",
)
def t8_index(spark, folder):
    """Texts that hold one of many phrases: the first two words of every document."""
    texts = docs(spark, folder).select("doc_id", "text")
    phrases = texts.select(F.lower(F.regexp_extract("text", r"[^ \n]+ [^ \n]+", 0)).alias("keyword"), (F.col("doc_id") % 2 == 0).alias("positive"))
    kinds = phrases.where(F.col("keyword").rlike("^[a-z]+ [a-z]+$")).groupBy("keyword").agg(F.min("positive").alias("positive"))
    hits = KW.keyword_counts(texts, "doc_id", "text", kinds, ["positive"])
    side = lambda c: F.coalesce(F.sum(F.when(c, F.col("hits"))), F.lit(0)).cast("bigint")
    return hits.groupBy("doc_id").agg(side(F.col("positive")).alias("positive"), side(~F.col("positive")).alias("negative"))


@query(
    "t9_format_prompt",
    f"-- result\n SELECT doc_id, {_prompt_sql(PROMPT_TEMPLATE, 'text', 'text')} AS prompt, {_prompt_sql(FEATURE_PROMPT_TEMPLATE, 'input', 'text')} AS feature_prompt FROM documents",
)
def t9(spark, folder):
    return docs(spark, folder).select(
        "doc_id", X.format_prompt(PROMPT_TEMPLATE, text="text").alias("prompt"),
        X.format_prompt(FEATURE_PROMPT_TEMPLATE, input="text").alias("feature_prompt"),
    )


GENERATED = """generated AS (SELECT event_id, CASE user_id % 6 WHEN 0 THEN 'Input: x' || chr(10) || 'Answer: Positive.' WHEN 1 THEN 'ANSWER:  negative, surely'
  WHEN 2 THEN 'answer:' || chr(10) || 'neutral' WHEN 3 THEN 'Answer: ' || event_type WHEN 4 THEN event_type ELSE 'Answer: positive Answer: negative' END AS generated FROM events)"""


def _generated(spark, folder):
    kind = F.pmod("user_id", F.lit(6))
    text = (
        F.when(kind == 0, F.lit("Input: x\nAnswer: Positive."))
        .when(kind == 1, F.lit("ANSWER:  negative, surely"))
        .when(kind == 2, F.lit("answer:\nneutral"))
        .when(kind == 3, F.concat(F.lit("Answer: "), "event_type"))
        .when(kind == 4, F.col("event_type"))
        .otherwise(F.lit("Answer: positive Answer: negative"))
    )
    return I.table(spark, folder, "events").select("event_id", text.alias("generated"))


@query(
    "t10_parse_generated_label",
    f"""WITH {GENERATED}, p AS (SELECT event_id, lower(regexp_extract(generated, '(?is)answer:\\s*([^,.\\s]*)', 1)) AS w FROM generated)
    -- result
    SELECT event_id, CASE WHEN w IN ('positive', 'negative', 'neutral') THEN w ELSE 'unknown' END AS label,
      CASE WHEN w IN ('positive', 'negative', 'neutral') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score FROM p""",
)
def t10(spark, folder):
    parsed = _generated(spark, folder).select("event_id", L.parse_generated_label(F.col("generated")).alias("label"))
    return parsed.withColumn("score", L.generated_score(F.col("label")))


@query(
    "t11_normalize_class_label",
    """WITH r AS (SELECT event_id, CASE user_id % 6 WHEN 0 THEN 'LABEL_0' WHEN 1 THEN '1' WHEN 2 THEN 'label_2' WHEN 3 THEN 'Positive' WHEN 4 THEN 'neutral' ELSE event_type END AS raw FROM events)
    -- result
    SELECT event_id, CASE lower(raw) WHEN 'label_0' THEN 'negative' WHEN '1' THEN 'neutral' WHEN 'label_2' THEN 'positive' WHEN 'positive' THEN 'positive' WHEN 'neutral' THEN 'neutral' ELSE 'unknown' END AS label FROM r""",
)
def t11(spark, folder):
    names = F.array(*[F.lit(v) for v in ("LABEL_0", "1", "label_2", "Positive", "neutral")], F.col("event_type"))
    raw = F.element_at(names, F.pmod("user_id", F.lit(6)).cast("int") + 1)
    return I.table(spark, folder, "events").select("event_id", L.normalize_class_label(raw).alias("label"))


@query(
    "t12_label_to_probs",
    f"""WITH {GENERATED}, p AS (SELECT event_id, lower(regexp_extract(generated, '(?is)answer:\\s*([^,.\\s]*)', 1)) AS w FROM generated)
    -- result
    SELECT event_id, CAST(w = 'positive' AS DOUBLE) AS sentiment_positive, CAST(w = 'negative' AS DOUBLE) AS sentiment_negative,
      CAST(w = 'neutral' AS DOUBLE) AS sentiment_neutral, CAST(w NOT IN ('positive', 'negative', 'neutral') AS DOUBLE) AS sentiment_unknown FROM p""",
)
def t12(spark, folder):
    parsed = _generated(spark, folder).select("event_id", L.parse_generated_label(F.col("generated")).alias("label"))
    return L.with_label_scores(parsed).drop("label")


@query(
    "t13_score_status_labels",
    f"""WITH {S.NEWS}, t AS (SELECT id, CASE lang WHEN 'fr' THEN '' WHEN 'de' THEN NULL ELSE lower(summary) END AS text, lang FROM news)
    -- result
    SELECT id, CASE WHEN coalesce(text, '') = '' THEN 'n/a' WHEN lang = 'es' THEN 'error' ELSE {S.label('text')} END AS sentiment_label,
      CASE WHEN coalesce(text, '') = '' OR lang = 'es' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS sentiment_score,
      CASE WHEN coalesce(text, '') = '' THEN 'n/a' ELSE 'unavailable' END AS without_model FROM t""",
)
def t13(spark, folder):
    """French texts are empty, German ones missing, and the scorer gives nothing for Spanish ones."""
    lang = F.col("lang")
    text = F.when(lang == "fr", F.lit("")).when(lang != "de", F.col("summary"))
    t = I.news(spark, folder).select("id", "lang", text.alias("text"))
    label = F.when(lang != "es", X.keyword_label("text", I.POSITIVE, I.NEGATIVE))
    without = L.score_status(F.col("text"), False, label, F.lit(1.0))["sentiment_label"].alias("without_model")
    status = L.score_status(F.col("text"), True, label, F.lit(1.0))
    return t.select("id", *[c.alias(n) for n, c in status.items()], without)


@query(
    "t14_safe_title",
    rf"""WITH {S.NEWS} -- result
    SELECT id, coalesce(nullif(replace(trim(substr(regexp_replace(headline, '[^\p{{L}}\p{{N}} _]', '_', 'g'), 1, 50)), ' ', '_'), ''), 'article') AS title FROM news""",
)
def t14(spark, folder):
    return I.news(spark, folder).select("id", X.safe_title("headline").alias("title"))


@query(
    "t15_sanitize_ticker",
    "-- result\n SELECT event_id, translate(event_type || '/^' || user_id, '/^', '_') AS tic FROM events",
)
def t15(spark, folder):
    raw = F.concat(F.col("event_type"), F.lit("/^"), F.col("user_id").cast("string"))
    return I.table(spark, folder, "events").select("event_id", X.sanitize_ticker(raw).alias("tic"))


@query(
    "t16_fmt_timestamp",
    """-- result
    SELECT event_id, strftime(ts, '%Y%m%dT%H%M%S') AS from_iso, strftime(make_timestamp(1700000000000000 + event_id * 60000000), '%Y%m%dT%H%M%S') AS from_unix FROM events""",
)
def t16(spark, folder):
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    plain = F.regexp_replace(iso, "Z$", "").try_cast("timestamp_ntz")
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    unix = epoch + F.make_dt_interval(secs=(1700000000 + F.col("event_id") * 60).cast("decimal(18,6)"))
    return I.table(spark, folder, "events").select(
        "event_id", X.compact_timestamp(plain).alias("from_iso"), X.compact_timestamp(unix).alias("from_unix")
    )


@query(
    "t17_text_lengths",
    f"-- result\n SELECT doc_id, length(text) AS original_length, length({S.processed('text')}) AS processed_length FROM documents",
)
def t17(spark, folder):
    return docs(spark, folder).select(
        "doc_id", F.length("text").cast("long").alias("original_length"),
        F.length(X.process_text("text")).cast("long").alias("processed_length"),
    )


@query(
    "t18_build_instruction_rows",
    f"""WITH d AS (SELECT doc_id, text, lower(text) AS t FROM documents WHERE regexp_matches(text, '\\S'))
    -- result
    SELECT doc_id, 'Analyze sentiment:' AS instruction, text AS input, {S.label('t')} AS output FROM d""",
)
def t18(spark, folder):
    return C.instruction_rows(docs(spark, folder), "text", I.POSITIVE, I.NEGATIVE, keep=["doc_id"])


def _ids(x: str) -> str:
    return (
        f"list_transform(list_filter(string_split_regex({x}, '[{S.WS}]+'), lambda w: w <> ''), "
        "lambda w: ('0x' || substr(md5(w), 1, 8))::BIGINT % 31999 + 1)"
    )


@query(
    "t19_tokenize_and_mask",
    f"""WITH d AS (SELECT doc_id, text, lower(text) AS t FROM documents), i AS (SELECT doc_id,
      list_slice({_ids("'Analyze sentiment:' || chr(10) || text || chr(10)")}, 1, 512) AS p, list_slice({_ids('(' + S.label('t') + ')')}, 1, 512) AS o FROM d)
    -- result
    SELECT doc_id, array_to_string(list_slice(list_concat(list_concat(p, o), [0]), 1, 512), ' ') AS input_ids,
      array_to_string(list_slice(list_concat(list_concat(list_transform(p, lambda x: -100), o), [0]), 1, 512), ' ') AS labels,
      CAST(least(len(p) + len(o) + 1, 512) AS INTEGER) AS mask_length FROM i""",
)
def t19(spark, folder):
    rows = C.instruction_rows(docs(spark, folder), "text", I.POSITIVE, I.NEGATIVE, keep=["doc_id"])
    tokens = C.tokenize_and_mask(rows, keep=["doc_id"])
    return tokens.select(
        "doc_id", F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
        F.array_join(F.col("labels").cast("array<string>"), " ").alias("labels"),
        F.size("attention_mask").alias("mask_length"),
    )


@query(
    "t20_extract_nested_source",
    "-- result\n SELECT doc_id, source AS source_name FROM documents",
)
def t20(spark, folder):
    payload = F.to_json(F.struct(F.struct(F.col("source").alias("name")).alias("source"), F.col("text").alias("title")))
    return docs(spark, folder).select("doc_id", payload.alias("raw")).select("doc_id", nested_source("raw").alias("source_name"))


@query("f1_predict_sentiment", f"WITH d AS (SELECT doc_id, lower(text) AS t FROM documents) -- result\n SELECT doc_id, {S.label('t')} AS label, 1.0::DOUBLE AS score FROM d")
def f1(spark, folder):
    make = SC.word_scorer(I.POSITIVE, I.NEGATIVE)
    return SC.predict_sentiment(docs(spark, folder), "text", make).select("doc_id", "label", "score")


@query(
    "f2_predict_valid_only",
    f"""WITH d AS (SELECT doc_id, lower(text) AS t FROM documents UNION ALL SELECT -1 - doc_id, ' ' || chr(10) FROM documents)
    -- result
    SELECT doc_id, CASE WHEN doc_id < 0 THEN 'unknown' ELSE {S.label('t')} END AS label, CASE WHEN doc_id < 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS score FROM d""",
)
def f2(spark, folder):
    make = SC.word_scorer(I.POSITIVE, I.NEGATIVE)
    full = docs(spark, folder).select("doc_id", "text")
    rows = full.unionByName(full.select((-1 - F.col("doc_id")).alias("doc_id"), F.lit(" \n").alias("text")))
    return SC.predict_valid_only(rows, "text", make).select("doc_id", "label", "score")


@query(
    "f3_batch_policy_predict",
    """-- result
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CASE WHEN 2 * l_discount - l_tax > 0.05 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS action FROM lineitem""",
)
def f3(spark, folder):
    def make():
        return lambda x: np.where(2 * x["l_discount"] - x["l_tax"] > 0.05, 1.0, -1.0)

    line = I.table(spark, folder, "lineitem").withColumn("l_linenumber", F.col("l_linenumber").cast("long"))
    return SC.batch_predict(line, ["l_discount", "l_tax"], make, ["l_orderkey", "l_linenumber"])
