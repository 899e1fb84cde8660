"""Streams over several micro-batches give what the batch jobs give."""

import datetime as dt

from pyspark.sql import functions as F

from tickloom.functions.labels import label_scores
from tickloom.operators import monitoring as M
from tickloom.plans import inputs as I
from tickloom.streaming import jobs as J


def in_files(df, path, order, files):
    """Write a table as several files in time order, so that each becomes a micro-batch."""
    from pyspark.sql import Window

    part = F.ntile(files).over(Window.orderBy(order))
    for i in range(1, files + 1):
        df.withColumn("_p", part).filter(F.col("_p") == i).drop("_p").coalesce(1).write.mode("append").parquet(path)
    return path


def test_bars_over_batches(spark, folder, tmp_path):
    path = in_files(I.table(spark, folder, "events"), str(tmp_path / "ev"), "ts", 3)
    ticks = J.read_stream(spark, path, "*.parquet", files_per_batch=1).select("ts", "event_id", "value", F.col("event_type").alias("tic"))
    got = J.bars_table(ticks, delay="30 days").withColumn("date", F.col("date").cast("timestamp_ntz"))
    want = I.bars_hourly(spark, folder)
    assert got.count() == want.count()
    assert got.select(*want.columns).exceptAll(want).count() == 0


def test_summary_over_batches(spark, folder, tmp_path):
    path = in_files(I.table(spark, folder, "events"), str(tmp_path / "ev"), "ts", 3)

    def log(df):
        return df.select("ts", F.col("event_type").alias("job"), F.pmod("user_id", F.lit(10)).alias("component"),
                         (F.col("event_type") != "error").alias("ok"))

    got = J.summary_table(log(J.read_stream(spark, path, "*.parquet", files_per_batch=1)), ["component"], delay="1 hour")
    want = M.minute_summary(log(I.table(spark, folder, "events")), ["component"])
    cols = ["component", "events", "errors"]
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0 and got.count() == want.count()
    a = M.sustained_failures(got, keys=["component"]).select("component", "minutes", "samples")
    b = M.sustained_failures(want, keys=["component"]).select("component", "minutes", "samples")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_repeated_articles_count_once(spark, tmp_path):
    day = dt.datetime(2024, 1, 1)
    rows = [(f"u{i % 4}", day, "A", "headline", "positive" if i % 2 else "negative") for i in range(8)]
    df = spark.createDataFrame(rows, "url string, published_at timestamp, tic string, headline string, label string")
    path = str(tmp_path / "news")
    for _ in range(2):
        df.coalesce(1).write.mode("append").parquet(path)

    def score(batch):
        return batch.withColumns({**label_scores(F.col("label")), "date": F.to_date("published_at")})

    got = J.sentiment_table(J.read_stream(spark, path, "*.parquet", files_per_batch=1), score).collect()
    assert len(got) == 1 and got[0].daily_news_count == 4 and got[0].daily_sentiment_positive_mean == 0.5


def test_stream_of_a_table_that_is_a_folder(spark, folder, tmp_path):
    """documents.parquet may be a folder of part files; each document still counts once."""
    want = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    want.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    want.limit(5).coalesce(1).write.parquet(str(tmp_path / "other.parquet"))
    stream = J.read_stream(spark, str(tmp_path), "documents.parquet", files_per_batch=1)
    got = J.run_to_store(stream).read().drop("batch_id")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
