"""The logical tables (ticks, bars, news, ...) as views of the supplied parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.labels import label_scores
from tickloom.functions.text import keyword_label, process_text
from tickloom.operators.bars import bars_from_ticks
from tickloom.session import scratch_path, spread

TICKERS = ("click", "error", "purchase", "signup", "view")
# The supplied text is invented words; these occur often in it.
POSITIVE = ("orantion", "thatin", "hehely")
NEGATIVE = ("ononst", "inoran", "attion")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def in_time_order(df: DataFrame, order: str, parts: int) -> str:
    """A folder with the rows in `parts` files of equal spans of time, written one after the other, for a stream to read."""
    path = scratch_path(df.sparkSession, "feed")
    ends = df.agg(F.unix_micros(F.min(order).cast("timestamp")).alias("a"), F.unix_micros(F.max(order).cast("timestamp")).alias("z")).first()
    at = F.unix_micros(F.col(order).cast("timestamp"))
    step = ((ends.z or 0) - (ends.a or 0)) // parts + 1
    for k in range(parts):
        part = df.where((at >= (ends.a or 0) + k * step) & (at < (ends.a or 0) + (k + 1) * step))
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id", "ts", "user_id", F.col("event_type").alias("tic"), "value"
    )


def day(ts: str = "ts") -> Column:
    return F.to_date(ts)


def hour(ts: str = "ts") -> Column:
    return F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz")


def bars_daily(spark: SparkSession, folder: str) -> DataFrame:
    return bars_from_ticks(ticks(spark, folder), day(), order=F.struct("ts", "event_id"))


def bars_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return bars_from_ticks(ticks(spark, folder), hour(), order=F.struct("ts", "event_id"))


def bars_long(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars per brand over the ship dates.

    A line number is at most 7, so order key and line number fit one number, which keeps the aggregate hashed.
    """
    line = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
        F.to_date("l_shipdate").alias("day"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("value"),
    )
    part = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("tic"))
    sold = line.join(part, "l_partkey")
    return bars_from_ticks(
        sold, F.col("day"), order=F.col("l_orderkey") * 8 + F.col("l_linenumber"), volume=F.sum("l_quantity")
    )


def index_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Stand-in market index: one level per day."""
    return ticks(spark, folder).groupBy(day().alias("date")).agg(F.avg("value").alias("level"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"), "doc_id")


def news(spark: SparkSession, folder: str) -> DataFrame:
    return as_news(documents(spark, folder))


def as_news(docs: DataFrame) -> DataFrame:
    slot = F.pmod(F.floor(F.col("doc_id") / 29), F.lit(5)).cast("int") + 1
    return docs.select(
        F.col("doc_id").alias("id"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("doc_id", F.lit(29)).cast("int"))
        .cast("timestamp_ntz").alias("published_at"),
        F.element_at(F.array(*[F.lit(t) for t in TICKERS]), slot).alias("tic"),
        F.substring_index("text", ".", 1).alias("headline"),
        F.col("text").alias("summary"),
        F.col("source").alias("source_name"),
        "lang",
    )


def with_day(news_df: DataFrame) -> DataFrame:
    return news_df.withColumn("date", F.to_date("published_at"))


def labelled_news(spark: SparkSession, folder: str) -> DataFrame:
    """News with its day, cleaned text and keyword label."""
    cleaned = with_day(news(spark, folder)).withColumn("processed_text", process_text("summary"))
    return cleaned.withColumn("label", keyword_label("processed_text", POSITIVE, NEGATIVE))


def scored_news(spark: SparkSession, folder: str) -> DataFrame:
    return labelled_news(spark, folder).withColumns(label_scores(F.col("label")))
