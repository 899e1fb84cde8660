"""Cleaning and labels on hand-made texts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tickloom.functions import labels as L
from tickloom.functions import text as X
from tickloom.functions.constants import STOPWORDS
from tickloom.operators import keywords as K

CLEANED = [
    ("A <em>ferry</em> left at dawn: see http://harbour.example/log now!", "ferry left dawn see"),
    ("Goats, goats & more GOATS!!! www.valley.example/goat?x=1 7%.", "goats goats goats 7"),
    ("<div>only <u>words</u></div>", "words"),
    ("mill <tag that\nspans> stone", "mill tag spans stone"),
    ("LOUD quiet Été über\u00a0tree\u2003bark\x1cleaf", "loud quiet été über tree bark leaf"),
    ("ht<b></b>tp://joined.example after", ""),
    ("", ""),
    ("   ", ""),
    ("the and of", ""),
    (None, None),
]


def test_process_text(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CLEANED)], "i int, t string")
    got = [r.p for r in df.withColumn("p", X.process_text("t")).orderBy("i").collect()]
    assert got == [want for _, want in CLEANED]


def test_stopwords_are_the_built_in_list():
    assert len(STOPWORDS) == 127 and len(set(STOPWORDS)) == 127


RISE, FALL = ["ripe", "harvest", "sunny", "fair wind"], ["frost", "blight", "storm"]
KEYWORD_CASES = [
    ("A sunny week, and the harvest is in.", "positive"),
    ("Frost came early; the storm took the rest.", "negative"),
    ("The ferry runs on Mondays.", "neutral"),
    ("sunny sunny sunny, then frost and blight", "negative"),
    ("ripened is not ripe-ish", "positive"),
    ("a fair wind", "positive"),
    ("fair\nwind", "neutral"),
    ("", "neutral"),
    (None, "neutral"),
    ("éripe is another word", "neutral"),
    ("HARVEST", "positive"),
]


def test_keyword_label(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(KEYWORD_CASES)], "i int, t string")
    got = [r.l for r in df.withColumn("l", X.keyword_label("t", RISE, FALL)).orderBy("i").collect()]
    assert got == [want for _, want in KEYWORD_CASES]


def test_keyword_index_equals_keyword_hits(spark):
    rng = random.Random(2)
    parts = ["ripe", "harvest", "été", "c++", "a+b", "$$", "%x", "fair wind", "wind fair", "9.5", "x_y"]
    words = sorted({" ".join(rng.choice(parts) for _ in range(rng.randint(1, 2))) for _ in range(60)})
    texts = ["".join(rng.choice([*parts, "wind", "fair", "Ripe"]) + rng.choice([" ", " ", "-", "", "  ", "."]) for _ in range(rng.randint(0, 12))) for _ in range(80)]
    df = spark.createDataFrame([*enumerate(texts), (98, None), (99, "")], "id int, t string")
    keywords = spark.createDataFrame([(w.upper(), i % 2 == 0) for i, w in enumerate(words)] + [(words[0].upper(), True), ("", True)], "keyword string, positive boolean")
    found = K.keyword_counts(df, "id", "t", keywords, ["positive"])
    got = {(r.id, r.positive): r.hits for r in found.collect()}
    for side in (True, False):
        chosen = [w for i, w in enumerate(words) if (i % 2 == 0) == side]
        for r in df.withColumn("n", X.keyword_hits(F.lower("t"), chosen)).collect():
            assert got.get((r.id, side), 0) == (r.n or 0), (r.t, side)


def test_keywords_join_moves_no_texts(spark):
    """A long text with many words that begin keywords is not copied for each of them."""
    words = [f"w{i}" for i in range(40)]
    df = spark.createDataFrame([(1, " ".join(words)), (1, " ".join(words)), (2, "w1 w3")], "id int, t string")
    keywords = spark.createDataFrame([(f"{a} {b}", True) for a in words for b in words] + [("w1", True)], "keyword string, positive boolean")
    found = K.keyword_counts(df, "id", "t", keywords, ["positive"])
    assert {(r.id, r.hits) for r in found.collect()} == {(1, 80), (2, 2)}
    joined, plans = [], [found._jdf.queryExecution().optimizedPlan()]
    while plans:
        plan = plans.pop()
        below = [plan.children().apply(i) for i in range(plan.children().size())]
        joined += [x.output().mkString(" ") for x in below if plan.nodeName() == "Join"]
        plans += below
    assert joined and not any("_text" in x for x in joined)
    assert K.keyword_counts(df, "id", "t", keywords.limit(0), ["positive"]).count() == 0


def test_keywords_with_signs(spark):
    texts = ["up 5% today", "up 5%x", "s&p 500 rose", "ps&p", "a+ rating", "a+b", "c++"]
    words = ["5%", "s&p", "a+", "new york"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.n for r in df.withColumn("n", X.keyword_hits(F.lower("t"), words)).orderBy("i").collect()]
    want = [sum(bool(re.search(rf"\b{re.escape(k)}\b", t.lower())) for k in words) for t in texts]
    assert got == want


def test_prompt_keeps_other_braces(spark):
    row = spark.range(1).select(X.format_prompt("{a/b} {input} {x}", input=F.lit("T")).alias("p")).first()
    assert row.p == "{a/b} T {x}"


def test_titles_and_tickers(spark):
    rows = spark.createDataFrame(
        [("Hello, World: 2024!", "^VIX"), ("", "BRK/B"), ("x" * 80, "AAPL")], "t string, k string"
    ).select(X.safe_title("t").alias("t"), X.sanitize_ticker("k").alias("k")).collect()
    assert [r.t for r in rows] == ["Hello__World__2024_", "article", "x" * 50]
    assert [r.k for r in rows] == ["VIX", "BRK_B", "AAPL"]


@pytest.mark.parametrize("text, label", [
    ("... Answer: Positive", "positive"), ("answer:negative.", "negative"), ("Answer: maybe", "unknown"),
    ("no mark", "unknown"), ("Answer:", "unknown"), ("ANSWER:\n neutral, yes", "neutral"),
])
def test_generated_label(spark, text, label):
    row = spark.createDataFrame([(text,)], "t string").select(L.parse_generated_label(F.col("t")).alias("l")).first()
    assert row.l == label


def test_unscored_rows_are_unknown(spark):
    df = spark.createDataFrame([("positive",), ("strange",), (None,)], "label string")
    rows = [tuple(r)[1:] for r in L.with_label_scores(df).collect()]
    assert rows == [(1.0, 0.0, 0.0, 0.0), (0.0, 0.0, 0.0, 1.0), (0.0, 0.0, 0.0, 1.0)]
