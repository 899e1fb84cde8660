"""The result store of streams: many micro-batches, retries, killed compactions, final days."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.plans import inputs as I
from tickloom.streaming import jobs as J
from tickloom.streaming.store import Store, newest, sums

SCHEMA = T.StructType([T.StructField("date", T.TimestampType()), T.StructField("tic", T.StringType()), T.StructField("value", T.LongType())])
START = dt.datetime(2024, 1, 1)


def batches(n, seed=1):
    """Hours that move on; each micro-batch changes rows of the newest few."""
    rng, hour = random.Random(seed), 0
    for _ in range(n):
        hour += rng.randint(0, 4)
        keys = {(START + dt.timedelta(hours=max(0, hour - rng.randint(0, 3))), rng.choice("ABC")) for _ in range(5)}
        yield [(*k, rng.randint(0, 99)) for k in sorted(keys)]


def content(store):
    return {(r.date, r.tic): r.value for r in store.read().collect()}


@pytest.mark.parametrize("kind", ["newest", "sums"])
def test_many_batches(spark, tmp_path, kind):
    store = Store(spark, str(tmp_path / "t"), SCHEMA, (newest if kind == "newest" else sums)(["date", "tic"]), "date", ("6 hours", "1 hour"), every=4)
    store.create()
    want = {}
    for i, rows in enumerate(batches(22)):
        df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
        store.write(df, i)
        if i % 5 == 0:
            store.write(df, i)  # retried
        for d, t, v in rows:
            want[d, t] = v if kind == "newest" else want.get((d, t), 0) + v
        if i % 7 == 6:
            assert content(store) == want
    assert content(store) == want
    assert store.read().count() == len(want)
    now = store.manifest()
    assert now.final_before is not None and now.through == 19
    folders = {t: len(os.listdir(tmp_path / "t" / t)) for t in ("deltas", "bases", "manifest")}
    assert folders["deltas"] <= 8 and folders["bases"] <= 3 and folders["manifest"] <= 3
    # Final days are not in the base.
    base = spark.read.parquet(store._slot("bases", now.generation))
    assert base.where(F.to_date("date") < F.lit(now.final_before)).count() == 0


@pytest.mark.parametrize("fails", ["bases", "manifest"])
def test_killed_compaction_loses_nothing(spark, tmp_path, monkeypatch, fails):
    store = Store(spark, str(tmp_path / "t"), SCHEMA, newest(["date", "tic"]), "date", ("6 hours",), every=3)
    store.create()
    want, rounds = {}, list(batches(12, seed=4))
    for i, rows in enumerate(rounds):
        df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
        want |= {(d, t): v for d, t, v in rows}
        if i in (5, 8):
            slot = Store._slot

            def broken(self, table, number, places=3, slot=slot):
                if table == fails:
                    now = self.manifest()
                    if number == now.generation + 1:
                        raise KeyboardInterrupt
                return slot(self, table, number, places)

            with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
                m.setattr(Store, "_slot", broken)
                store.write(df, i)
            assert content(store) == want
            store = Store(spark, store.path, SCHEMA, store.merge, "date", ("6 hours",), every=3)
            store.create()  # keeps what is there
        store.write(df, i)
        assert content(store) == want


def test_rows_without_a_period_stay(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"), SCHEMA, newest(["date", "tic"]), "date", every=1)
    store.create()
    store.write(spark.createDataFrame([(None, "A", 1), (START, "A", 2)], SCHEMA), 0)
    store.write(spark.createDataFrame([(START + dt.timedelta(days=9), "A", 3)], SCHEMA), 1)
    store.write(spark.createDataFrame([], SCHEMA), 2)
    assert content(store) == {(None, "A"): 1, (START, "A"): 2, (START + dt.timedelta(days=9), "A"): 3}


def test_stream_goes_on_where_it_ended(spark, folder, tmp_path):
    """Bars over micro-batches in two runs equal the batch job, and compaction has taken place."""
    ticks = I.table(spark, folder, "events").select("ts", "event_id", "value", F.col("event_type").alias("tic"))
    feed, path = str(tmp_path / "feed"), str(tmp_path / "bars")
    days = sorted(r.d for r in ticks.select(F.to_date("ts").alias("d")).distinct().collect())
    cut = [days[0], days[6], days[12], days[18], days[24], days[-1] + dt.timedelta(days=1)]
    for k in range(5):
        ticks.where((F.to_date("ts") >= F.lit(cut[k])) & (F.to_date("ts") < F.lit(cut[k + 1]))).coalesce(1).write.mode("append").parquet(feed)
        if k in (2, 4):
            got = J.bars_table(J.read_stream(spark, feed, "*.parquet", files_per_batch=1), path=path, every=2)
    got = got.withColumn("date", F.col("date").cast("timestamp_ntz"))
    want = I.bars_hourly(spark, folder)
    assert got.count() == want.count() and got.select(*want.columns).exceptAll(want).count() == 0
    assert len(os.listdir(tmp_path / "bars" / "table" / "deltas")) <= 4
