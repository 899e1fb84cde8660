"""Streaming forms of the bar, news and monitoring jobs.

Each stream keeps windowed aggregates under a watermark and, in update mode, writes the changed rows of each
micro-batch to a store (`tickloom.streaming.store`), which keeps the newest row of each key. Rules and joins then run on
those small tables with the same functions as the batch jobs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.bars import ohlcv
from tickloom.operators.monitoring import minute_summary
from tickloom.session import scratch_path
from tickloom.streaming.store import Merge, Store, newest, sums


def read_stream(spark: SparkSession, folder: str, pattern: str, files_per_batch: int | None = None) -> DataFrame:
    """Parquet tables of a folder as a stream, in the schema of what is there: files that match `pattern`, or folders of files."""
    # A glob path opens folders that match; the option pathGlobFilter would be held against the files inside them.
    path = f"{folder}/{{{pattern}}}"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def event_time(stream: DataFrame, column: str, delay: str) -> DataFrame:
    """Watermark on a time column; times without a zone are taken in the session's."""
    return stream.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def run_to_store(stream: DataFrame, merge: Merge | None = None, mode: str = "update", prepare: Callable[[DataFrame], DataFrame] | None = None, path: str | None = None, **options: object) -> Store:
    """Process what is available into a store at `path`, a new one by default, and return it.

    Without `merge` rows are only added. Run again with the same path, the stream goes on where it ended.
    """
    spark = stream.sparkSession
    base = path or scratch_path(spark, "stream")
    shape = prepare(spark.createDataFrame([], stream.schema)).schema if prepare else stream.schema
    store = Store(spark, f"{base}/table", shape, **({"merge": merge} if merge else {}), **options)
    store.create()

    def write(batch: DataFrame, batch_id: int) -> None:
        store.write(prepare(batch) if prepare else batch, batch_id)

    query = (
        stream.writeStream.outputMode(mode).foreachBatch(write)
        .option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return store


def stream_bars(ticks: DataFrame, width: str = "1 hour", delay: str = "10 minutes", order: Column | None = None) -> DataFrame:
    """OHLCV bars of tumbling windows, kept until `delay` after a window's end."""
    order = F.struct("ts", "event_id") if order is None else order
    sums = (
        event_time(ticks, "ts", delay).groupBy(F.window("ts", width).alias("w"), "tic")
        .agg(*ohlcv(F.col("value"), order, F.count(F.lit(1))))
    )
    return sums.select(F.col("w.start").alias("date"), "tic", "open", "high", "low", "close", "volume")


def bars_table(ticks: DataFrame, width: str = "1 hour", delay: str = "10 minutes", path: str | None = None, every: int = 8) -> DataFrame:
    """Bars of all ticks that are available; a window is final once the watermark has passed its end."""
    store = run_to_store(stream_bars(ticks, width, delay), newest(["date", "tic"]), period="date", settled=(delay, width), path=path, every=every)
    return store.read().drop("batch_id")


def summary_table(events: DataFrame, keys: Sequence[str], delay: str = "10 minutes") -> DataFrame:
    """Per-minute summary of job events, maintained by a stream; every alert rule reads it."""
    minutes = minute_summary(event_time(events, "ts", delay), keys)
    return run_to_store(minutes, newest(["minute", *keys]), period="minute", settled=(delay, "1 minute")).read().drop("batch_id")


SCORES = ("sentiment_positive", "sentiment_negative", "sentiment_neutral", "sentiment_unknown")


def daily_sums(scored: DataFrame) -> DataFrame:
    """Mergeable daily sentiment: sums and counts instead of means."""
    return scored.groupBy("date", "tic").agg(
        *[F.sum(c).alias(c) for c in SCORES], F.count(F.lit(1)).alias("n"), F.count("headline").alias("headlines")
    )


def sentiment_table(
    news: DataFrame, score: Callable[[DataFrame], DataFrame], unique: str = "url", delay: str = "40 days"
) -> DataFrame:
    """Daily sentiment per ticker from a stream of articles, each counted once.

    An article seen again within `delay` is dropped. Each micro-batch adds its sums, so late articles
    simply add to their day.
    """
    fresh = event_time(news, "published_at", delay).dropDuplicatesWithinWatermark([unique])
    store = run_to_store(fresh, sums(["date", "tic"]), "append", lambda batch: daily_sums(score(batch)), period="date", settled=(delay, "1 day"))
    means = [(F.col(c) / F.col("n")).alias(f"daily_{c}_mean") for c in SCORES]
    return store.read().select("date", "tic", *means, F.col("headlines").alias("daily_news_count"))
