"""Joins, splits, drift, sources, sinks, scoring and settings."""

import datetime as dt
import json
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom import config
from tickloom.operators import curation as C
from tickloom.operators import drift as D
from tickloom.operators import features as X
from tickloom.operators import frames as FR
from tickloom.operators import profile as P
from tickloom.operators import scoring as SC
from tickloom.operators.ranks import exact_quantiles
from tickloom.session import cut, scratch_root, spread
from tickloom.sources import normalize as NZ
from tickloom.sources import readers as R
from tickloom.sources import sinks as W


def bars(spark):
    return spark.createDataFrame(
        [(dt.date(2024, 1, d), t, 1.0) for d in (1, 2) for t in ("A", "B")], "date date, tic string, close double")


def scored(spark, rows):
    return spark.createDataFrame(
        rows, "date date, tic string, headline string, sentiment_positive double, sentiment_negative double, "
              "sentiment_neutral double, sentiment_unknown double")


def test_days_without_news_are_unknown(spark):
    news = scored(spark, [(dt.date(2024, 1, 1), "A", "h", 1.0, 0.0, 0.0, 0.0), (dt.date(2024, 1, 1), "B", None, 1.0, 0.0, 0.0, 0.0)])
    got = {(r.date.day, r.tic): tuple(r)[3:] for r in X.join_ticker_sentiment(bars(spark), news).collect()}
    assert got[1, "A"] == (1.0, 0.0, 0.0, 0.0, 1)
    # an article without a headline does not count, so its day is a day without news
    assert got[1, "B"] == (0.0, 0.0, 0.0, 1.0, 0) == got[2, "A"] == got[2, "B"]


def test_day_only_join_needs_one_ticker(spark):
    news = scored(spark, [(dt.date(2024, 1, 1), "A", "h", 1.0, 0.0, 0.0, 0.0)]).drop("tic")
    one = X.join_ticker_sentiment(bars(spark).filter("tic = 'A'"), news).filter("date = '2024-01-01'").first()
    two = X.join_ticker_sentiment(bars(spark), news).first()
    assert one.daily_sentiment_positive_mean == 1.0 and two.daily_sentiment_positive_mean is None


def test_no_news_at_all_is_zero(spark):
    row = X.join_ticker_sentiment(bars(spark), None).first()
    assert row.daily_sentiment_unknown_mean == 0.0 and row.daily_news_count == 0


def test_broadcast_tables_have_one_row_per_day(spark):
    day = dt.date(2024, 1, 1)
    index = spark.createDataFrame([(day, 10.0)], "date date, level double")
    got = {r.date.day: r.vix for r in X.join_market_index(bars(spark), index).collect()}
    assert got == {1: 10.0, 2: None}
    with pytest.raises(Exception, match="several rows on"):
        X.join_market_index(bars(spark), index.union(index)).collect()


def test_page_cap_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 2 AS source_name", "id", "id AS published_at")
    capped = FR.newest_per_query(df, limit=10)
    assert capped.count() == 20
    assert capped._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


def test_next_session(spark):
    sessions = spark.createDataFrame([("A", dt.date(2024, 1, 2)), ("A", dt.date(2024, 1, 5))], "tic string, date date")
    news = spark.createDataFrame([(i, "A", dt.date(2024, 1, d)) for i, d in enumerate((1, 2, 3, 5, 6))] + [(9, "Z", dt.date(2024, 1, 1))],
                                 "id int, tic string, date date")
    got = {r.id: r.session and r.session.day for r in X.shift_to_session(news, sessions).collect()}
    assert got == {0: 2, 1: 2, 2: 5, 3: 5, 4: None, 9: None}


def test_split_is_disjoint_covering_and_stable(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    a_train, a_val = FR.train_validation_split(ids, 0.1, 42, "doc_id")
    _, b_val = FR.train_validation_split(ids.repartition(13), 0.1, 42, "doc_id")
    assert a_train.count() + a_val.count() == 20_000 and a_train.join(a_val, "doc_id").count() == 0
    assert sorted(r[0] for r in a_val.collect()) == sorted(r[0] for r in b_val.collect())
    assert 0.09 < a_val.count() / 20_000 < 0.11
    empty = FR.train_validation_split(ids.filter("doc_id < 0"), 0.1, 42, "doc_id")
    assert [d.count() for d in empty] == [0, 0]


def drift_pair(spark):
    rng = np.random.default_rng(1)
    ref = [(float(rng.random()), int(rng.integers(0, 10)), str(rng.choice(list("ABC")))) for _ in range(100)]
    cur = [(float(rng.random()) + 0.5, int(rng.integers(0, 12)), str(rng.choice(list("ABD"))), 1.0) for _ in range(80)]
    schema = "feature1 double, feature2 int, category string"
    return spark.createDataFrame(ref, schema), spark.createDataFrame(cur, schema + ", new_feature double")


def test_drift(spark):
    ref, cur = drift_pair(spark)
    report = {(r.check, r.column): r.drifted for r in D.drift_report(ref, cur).collect()}
    assert report["column_count", "*"] and report["mean_shift", "feature1"] and report["overall", "*"]
    same = {(r.check, r.column): r.drifted for r in D.drift_report(ref, ref).collect()}
    assert not any(same.values())
    assert D.ks_statistic(ref, ref, ["feature1"]).first().ks == 0.0
    chi = D.chi_square(ref, cur, ["category"]).first()
    assert chi.new_categories == 1 and chi.categories == 3


def test_quantiles_with_a_hot_value(spark):
    values = [5.0] * 3000 + [float(i) for i in range(6001)]
    df = spark.createDataFrame([("x", v) for v in values], "g string, v double").repartition(7)
    row = exact_quantiles(df, "g", "v", [0.0, 0.25, 0.37, 0.5, 1.0]).first()
    assert tuple(row)[1:] == pytest.approx(tuple(np.quantile(values, [0.0, 0.25, 0.37, 0.5, 1.0])))


def test_describe(spark):
    pdf = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (None, "b"), (4.0, None)], "x double, s string")
    row = P.describe_numeric(pdf, ["x"]).first()
    assert (row["count"], row["mean"], row["p50"]) == (3, pytest.approx(7 / 3), 2.0)
    text = P.describe_text(pdf, ["s"]).first()
    assert (text["count"], text["unique"], text["top"], text["freq"]) == (3, 2, "b", 2)
    assert {r["column"]: r.nulls for r in P.null_counts(pdf).collect()} == {"x": 1, "s": 1}


def test_require_columns(spark):
    with pytest.raises(ValueError, match="volume"):
        FR.require_columns(bars(spark), ["tic", "volume"])


def test_pick_columns():
    wide = [f"c{i}" for i in range(16)]
    assert FR.pick_columns(wide[:15]) == wide[:15] and FR.pick_columns(wide) == wide[:15]
    assert FR.pick_columns([*wide, "close", "sentiment_label"]) == ["sentiment_label", "close"]
    assert FR.pick_columns(wide, ["c9", "c2", "none", "c4"], 2) == ["c9", "c2"]


def test_json_list_and_single_object(spark, tmp_path):
    (tmp_path / "list.json").write_text(json.dumps([{"id": "1", "headline": "a"}, {"id": "2", "headline": "b"}]))
    (tmp_path / "one.json").write_text(json.dumps({"id": "3", "headline": "c"}, indent=2))
    from tickloom.schemas import ARTICLES
    got = sorted(r.id for r in R.scan_json_array(spark, str(tmp_path), ARTICLES).collect())
    assert got == ["1", "2", "3"]


def test_blank_files_are_left_out(spark, tmp_path):
    for name, text in (("a.txt", "line 1\nline 2"), ("b.txt", "  \n\t "), ("c.txt", "")):
        (tmp_path / name).write_text(text)
    assert [r.text for r in R.scan_text_files(spark, str(tmp_path)).collect()] == ["line 1\nline 2"]


def test_sources_without_any_left(spark):
    with pytest.raises(ValueError):
        R.scan_sources(spark, [{"name": "off", "enabled": False, "read": lambda: None}])


def test_fallback_only_when_empty(spark):
    a, b = spark.createDataFrame([("a",)], "x string"), spark.createDataFrame([("b",)], "x string")
    assert [r.x for r in R.fallback_source(a, b).collect()] == ["a"]
    assert [r.x for r in R.fallback_source(a.filter("x = 'none'"), b).collect()] == ["b"]


def test_payloads(spark):
    first = json.dumps({"publishedAt": "2024-01-05T10:00:00Z", "source": {"name": "S"}, "title": "T", "description": None, "url": "u"})
    second = json.dumps({"datetime": 1704448800, "source": "S2", "headline": "H", "summary": "D", "url": "v", "id": 7})
    bad = json.dumps({"publishedAt": "soon", "source": None, "title": "T2"})
    raw = spark.createDataFrame([(first,), (bad,)], "raw string")
    rows = NZ.primary_news(raw).orderBy("headline").collect()
    assert rows[0].source_name == "S" and rows[0].published_at.hour == 10 and rows[1].published_at is None
    other = spark.createDataFrame([(second,), (json.dumps({"datetime": 0, "headline": "x"}),)], "raw string")
    assert NZ.secondary_news(other, "2024-01-05", "2024-01-05").count() == 1
    assert NZ.secondary_news(other, "2024-01-06", "2024-01-07").count() == 0
    assert NZ.canonical_news(NZ.primary_news(raw)).count() == 1


def test_empty_sinks(spark, tmp_path):
    empty = bars(spark).filter("close < 0")
    assert not W.sink_parquet_if_nonempty(empty, str(tmp_path / "none"))
    W.sink_csv_with_header(empty, str(tmp_path / "head"))
    text = "".join(p.read_text() for p in (tmp_path / "head").glob("*.csv"))
    assert text.strip() == "date,tic,close"
    W.sink_with_schema(empty, str(tmp_path / "schema"))
    assert spark.read.parquet(str(tmp_path / "schema")).columns == ["date", "tic", "close"]


def test_day_folders_prune(spark, tmp_path):
    path = W.sink_by_date(bars(spark), str(tmp_path / "days"))
    plan = R.scan_date_partition(spark, path, "2024-01-02")
    assert plan.count() == 2 and "PartitionFilters: [isnotnull(date" in plan._jdf.queryExecution().toString()


def test_scoring_skips_blanks_and_keeps_rows(spark):
    def make():
        def score(texts):
            assert all(t.strip() for t in texts) and len(texts) <= 2
            return [{"label": "positive", "score": 0.5}] * len(texts)
        return score

    df = spark.createDataFrame([(i, t) for i, t in enumerate(["a", " ", None, "b", "c", "d"])], "id int, t string")
    got = {r.id: (r.label, r.score) for r in SC.predict_sentiment(df, "t", make, batch=2).collect()}
    valid = {r.id: (r.label, r.score) for r in SC.predict_valid_only(df, "t", make, 2).collect()}
    assert got == {0: ("positive", 0.5), 1: ("unknown", 0.0), 2: ("unknown", 0.0), 3: ("positive", 0.5), 4: ("positive", 0.5), 5: ("positive", 0.5)}
    assert valid.keys() == got.keys() and valid[1] == ("unknown", 0.0)


def test_masked_tokens(spark):
    df = spark.createDataFrame([([1, 2, 3], [7]), ([1, 2, 3, 4, 5, 6], [7]), ([1, 2], [9])], "p array<int>, o array<int>")
    cols = C.masked_tokens(F.col("p"), F.col("o"), 5, 9)
    rows = df.select(*[c.alias(n) for n, c in cols.items()]).collect()
    assert (rows[0].input_ids, rows[0].labels) == ([1, 2, 3, 7, 9], [-100, -100, -100, 7, 9])
    assert (rows[1].input_ids, rows[1].labels) == ([1, 2, 3, 4, 5], [-100] * 5)
    assert (rows[2].input_ids, rows[2].labels) == ([1, 2, 9], [-100, -100, 9])
    assert all(len(r.input_ids) == len(r.labels) == len(r.attention_mask) for r in rows)


def test_pandas_tokenizer(spark):
    tok = C.pandas_tokenizer(lambda: lambda t: [len(w) for w in t.split()])
    rows = spark.createDataFrame([("Do:", "aa bbb", "neutral")], "instruction string, input string, output string")
    got = C.tokenize_and_mask(rows, tokenizer=tok, limit=10).first()
    assert got.input_ids == [3, 2, 3, 7, 0] and got.labels == [-100, -100, -100, 7, 0]


def test_instruction_rows_skip_blank(spark):
    docs = spark.createDataFrame([("good gains",), ("  ",), (None,)], "t string")
    rows = C.instruction_rows(docs, "t", ["gains"], ["loss"]).collect()
    assert [(r.input, r.output) for r in rows] == [("good gains", "positive")]


def test_settings():
    got = config.resolve({"seed": 7, "indicators": ["macd"]}, {"seed": None, "risk_threshold": 5.0})
    assert (got.seed, got.indicators, got.risk_threshold) == (7, ("macd",), 5.0)
    with pytest.raises(ValueError):
        config.resolve({"no_such": 1})


def test_scratch_is_the_clusters_folder(spark):
    setting = {"spark.checkpoint.dir": "/shared/folder/"}
    conf = SimpleNamespace(get=lambda key, default=None: setting.get(key, default))
    cluster = SimpleNamespace(sparkContext=SimpleNamespace(getConf=lambda: conf))
    assert scratch_root(cluster) == "/shared/folder"
    assert cut(bars(spark)).count() == 4


def test_spread_leaves_wide_scans_alone(spark):
    wide = spark.range(0, 1000, 1, 64)
    assert spread(wide, "id") is wide and spread(spark.range(0, 1000, 1, 1), "id").rdd.getNumPartitions() == 8
