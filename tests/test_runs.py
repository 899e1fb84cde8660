"""Tables of runs, sinks that run a plan once, reasons of sources left out, payloads of unknown shape."""

import json

import pytest
from pyspark.sql import functions as F

from tickloom.operators import drift as D
from tickloom.sources import normalize as NZ
from tickloom.sources import readers as R
from tickloom.sources import runs as RU
from tickloom.sources import sinks as W


def rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x bigint")


def counted(spark, n):
    """A table of n rows whose tasks add up the rows that they make, and the sum."""
    made = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            made.add(len(b))
            yield b

    return spark.range(n).mapInPandas(run, "id bigint"), made


def test_newest_finished_run(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="no finished run"):
        RU.scan_newest_run(spark, path)
    assert RU.publish_run(rows(spark, 1, 2), path, "a") == 2
    assert RU.publish_run(rows(spark, 3), path, "b") == 1
    # a run that broke off: rows, some of them unreadable, that the list does not name
    rows(spark, 9).write.parquet(f"{path}/rows/part=half")
    (tmp_path / "t" / "rows" / "part=half" / "bad.parquet").write_text("no parquet")
    assert [r.x for r in RU.scan_newest_run(spark, path).collect()] == [3]
    assert sorted(r.x for r in RU.scan_runs(spark, path).collect()) == [1, 2, 3]


def test_an_attempt_counts_once(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        assert RU.publish_run(rows(spark, 1, 2), path, "a") == 2
    assert RU.publish_run(rows(spark, 5, 6, 7), path, "a") == 2  # the attempt is there already
    assert RU.publish_run(rows(spark, 5), path, "a", attempt=1) == 1
    assert sorted(map(tuple, RU.list_runs(spark, path).collect())) == [("a", 0, 2), ("a", 1, 1)]
    assert sorted(r.x for r in RU.scan_runs(spark, path).collect()) == [1, 2, 5]


def test_two_writers_of_one_attempt(spark, tmp_path):
    path = str(tmp_path / "t")
    RU.publish_run(rows(spark, 1, 2), path, "a")
    rows(spark, 1, 2).write.parquet(f"{path}/rows/part=zz")
    spark.createDataFrame([("a", 0, "zz", 2, "{}")], RU.LIST).write.mode("append").parquet(f"{path}/list")
    assert RU.scan_runs(spark, path).count() == 2


def test_runs_without_rows_and_other_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    assert RU.publish_run(rows(spark), path, "a", skip_empty=True) == 0
    assert RU.list_runs(spark, path).count() == 0
    assert RU.publish_run(rows(spark), path, "a") == 0 and RU.scan_newest_run(spark, path).count() == 0
    RU.publish_run(spark.createDataFrame([(1, "y")], "x bigint, run string"), path, "b")  # a column called like one of the list's
    assert RU.scan_newest_run(spark, path).first().run == "y"
    assert [tuple(r) for r in RU.scan_runs(spark, path).select("x", "run").collect()] == [(1, "b")]


def test_metrics_of_attempts(spark, tmp_path):
    path = str(tmp_path / "m")
    first = spark.createDataFrame([("loss", 0.5, 1), ("loss", 0.4, 2)], "key string, value double, step bigint")
    assert [D.append_metrics(first, path, "r") for _ in range(3)] == [2, 2, 2]
    D.append_metrics(first.where("step = 1").withColumn("value", F.lit(0.7)), path, "r", attempt=1)
    kept = D.stored_metrics(spark, path)
    assert sorted((r.step, r.value) for r in kept.collect()) == [(1, 0.7), (2, 0.4)]
    assert D.latest_metrics(kept).first().value == 0.4


def test_sinks_run_the_plan_once(spark, tmp_path):
    df, made = counted(spark, 100)
    assert W.sink_parquet_if_nonempty(df, str(tmp_path / "some")) and made.value == 100
    assert spark.read.parquet(str(tmp_path / "some")).count() == 100
    assert not W.sink_parquet_if_nonempty(spark.range(0), str(tmp_path / "some"))
    assert spark.read.parquet(str(tmp_path / "some")).count() == 100  # what was there stays
    df, made = counted(spark, 50)
    W.sink_csv_with_header(df, str(tmp_path / "csv"))
    assert made.value == 50 and spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 50
    df, made = counted(spark, 30)
    wrote = W.sink_outputs(df, {"low": (str(tmp_path / "low"), F.col("id") < 10, ["id"]), "none": (str(tmp_path / "none"), F.col("id") < 0, ["id"])})
    assert wrote == {"low": 10, "none": 0} and made.value == 30


def test_sources_left_out(spark):
    def broken():
        raise KeyError("a mistake of the caller")

    good = {"name": "good", "read": lambda: rows(spark, 1)}
    missing = {"name": "missing", "read": lambda: spark.read.parquet("/nowhere/at/all")}
    column = {"name": "column", "read": lambda: rows(spark, 1).select("y")}
    both, left_out = R.read_sources(spark, [good, missing, column, {"name": "off", "enabled": False, "read": broken}])
    assert [tuple(r) for r in both.collect()] == [(1, "good")]
    assert {r.source: r.reason.split(".")[0] for r in left_out.collect()} == {
        "missing": "PATH_NOT_FOUND", "column": "UNRESOLVED_COLUMN", "off": "disabled"}
    with pytest.raises(ValueError, match="missing"):
        R.scan_sources(spark, [good, missing])
    assert R.scan_sources(spark, [good, missing], allowed=["missing"]).columns == ["x"]
    with pytest.raises(KeyError):
        R.read_sources(spark, [{"name": "broken", "read": broken}])


def test_payloads_of_unknown_shape(spark):
    texts = [
        json.dumps({"publishedAt": "2024-01-05T10:00:00Z", "source": {"name": "S"}, "title": "T", "url": "u"}),
        json.dumps({"publishedAt": 17, "source": {"id": 3}, "title": ["T"], "url": None, "tags": {"a": 1}}),
        json.dumps({"datetime": 1704448800, "source": "S2", "headline": "H"}),
        json.dumps({"datetime": 0, "source": 5}),
        "[1, 2]", "{broken", "", None,
    ]
    read = NZ.any_news(spark.createDataFrame([(t,) for t in texts], "raw string"))
    got = {r.raw_data: (r.published_at and r.published_at.hour, r.source_name, r.headline, r.api_source, r.url) for r in read.collect()}
    assert [got[t] for t in texts] == [
        (10, "S", "T", "primary", "u"), (None, None, None, "primary", None), (10, "S2", "H", "secondary", None),
        (None, None, None, "secondary", None), *[(None, None, None, "unknown", None)] * 4]
    fields = NZ.payload_fields(read)
    stated = {"primary": {"publishedAt": "STRING", "source": "OBJECT", "title": "STRING", "url": "STRING"},
              "secondary": {"datetime": "BIGINT", "source": "STRING", "headline": "STRING"}}
    changed = {(r.api_source, r.field): (r.expected, r.type.split("<")[0], r.n) for r in NZ.changed_fields(fields, stated).collect()}
    assert changed == {
        ("primary", "publishedAt"): ("STRING", "BIGINT", 1), ("primary", "title"): ("STRING", "ARRAY", 1),
        ("primary", "tags"): (None, "OBJECT", 1), ("secondary", "source"): ("STRING", "BIGINT", 1)}
