"""Article payloads of the two kinds of news sources as canonical news rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.schemas import NEWS, PRIMARY_PAYLOAD, SECONDARY_PAYLOAD


def nested_source(payload: Column | str) -> Column:
    """`source.name` of a JSON article."""
    return F.get_json_object(payload, "$.source.name")


def primary_news(raw: DataFrame, column: str = "raw", api: str = "primary") -> DataFrame:
    """Articles with ISO times and a nested source. Unreadable times become NULL."""
    p = F.from_json(column, PRIMARY_PAYLOAD)
    return raw.select(F.col(column).alias("raw_data"), p.alias("p")).select(
        F.col("p.publishedAt").try_cast("timestamp").alias("published_at"),
        F.col("p.source.name").alias("source_name"),
        F.col("p.title").alias("headline"),
        F.col("p.description").alias("description"),
        F.lit(api).alias("api_source"),
        F.col("p.url").alias("url"),
        "raw_data",
    )


def _utc_seconds(day: str) -> Column:
    """Unix seconds at which a day begins in UTC, whatever the session's time zone is."""
    return F.unix_date(F.lit(day).cast("date")).cast("long") * 86400


def secondary_news(
    raw: DataFrame, first: str | None = None, last: str | None = None, column: str = "raw", api: str = "secondary"
) -> DataFrame:
    """Articles with unix seconds, kept from the start of `first` through the end of `last`. No time, no row."""
    p = F.from_json(column, SECONDARY_PAYLOAD)
    parsed = raw.select(F.col(column).alias("raw_data"), p.alias("p")).filter("p.datetime <> 0")
    if first:
        parsed = parsed.filter(F.col("p.datetime") >= _utc_seconds(first))
    if last:
        parsed = parsed.filter(F.col("p.datetime") < _utc_seconds(last) + 86400)
    return parsed.select(
        F.timestamp_seconds("p.datetime").alias("published_at"),
        F.col("p.source").alias("source_name"),
        F.col("p.headline").alias("headline"),
        F.col("p.summary").alias("description"),
        F.lit(api).alias("api_source"),
        F.col("p.url").alias("url"),
        "raw_data",
    )


def canonical_news(news: DataFrame) -> DataFrame:
    """Articles with a time and a headline, canonical columns, newest first."""
    have = set(news.columns)
    full = news.select(*[
        F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in NEWS
    ])
    return full.dropna("any", subset=["published_at", "headline"]).orderBy(F.desc("published_at"))


def any_news(raw: DataFrame, column: str = "raw") -> DataFrame:
    """Articles of either kind of source in one pass, told apart by their fields, with the payload as a VARIANT.

    Each field is taken where it has a fitting type and is NULL elsewhere, so a payload whose types changed keeps its other
    fields. Text that is no JSON gives a row of NULLs with api_source 'unknown'.
    """
    def get(name: str, kind: str = "string") -> Column:
        return F.try_variant_get("payload", f"$.{name}", kind)

    def text(name: str) -> Column:
        return F.when(F.schema_of_variant(get(name, "variant")) == "STRING", get(name))

    has_time, has_seconds = get("publishedAt", "variant").isNotNull(), get("datetime", "variant").isNotNull()
    seconds = F.when(get("datetime", "bigint") != 0, F.timestamp_seconds(get("datetime", "bigint")))
    return raw.select(F.col(column).alias("raw_data"), F.try_parse_json(column).alias("payload")).select(
        F.coalesce(text("publishedAt").try_cast("timestamp"), seconds).alias("published_at"),
        F.coalesce(get("source.name"), text("source")).alias("source_name"),
        F.coalesce(text("title"), text("headline")).alias("headline"),
        F.coalesce(text("description"), text("summary")).alias("description"),
        F.when(has_time, "primary").when(has_seconds, "secondary").otherwise("unknown").alias("api_source"),
        text("url").alias("url"),
        "raw_data", "payload",
    )


def payload_fields(news: DataFrame, by: str = "api_source", column: str = "payload") -> DataFrame:
    """(`by`, field, type, n): how often each top-level field of the payloads has each type, VOID for a JSON null.

    Payloads that are lists or single values have no field."""
    fields = news.select(by, column).lateralJoin(news.sparkSession.tvf.variant_explode(F.col(column).outer()))
    return fields.where("key IS NOT NULL").groupBy(by, F.col("key").alias("field"), F.schema_of_variant("value").alias("type")).agg(F.count("*").alias("n"))


def changed_fields(fields: DataFrame, stated: dict[str, dict[str, str]], by: str = "api_source") -> DataFrame:
    """Rows of payload_fields() that are not as `stated`, kind -> field -> type (a prefix such as OBJECT will do), with what was expected.

    `expected` is NULL for an unknown field. JSON nulls are no change.
    """
    rows = [(kind, field, kept) for kind, known in stated.items() for field, kept in known.items()]
    known = fields.sparkSession.createDataFrame(rows, f"{by} string, field string, expected string")
    both = fields.where("type <> 'VOID'").join(known, [by, "field"], "left")
    return both.where(F.col("expected").isNull() | ~F.startswith("type", "expected")).select(by, "field", "expected", "type", "n")
