"""Near-duplicate lines against plain edit distances: short lines, repeated doc_ids, groups of near copies, clashing names."""

import random

import pytest
from pyspark.sql import functions as F

from tickloom.llm import line_dedup

SCHEMA = "doc_id bigint, text string, removed string, text_hash int, doc string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, before[j] + 1, before[j - 1] + (x != y)))
    return row[-1]


def near(a, b, tau, each):
    return a != b and distance(a, b) <= min(tau, min(len(a), len(b)) // each)


def edited(rng, line, n):
    for _ in range(n):
        i = rng.randrange(len(line))
        line = rng.choice([line[:i] + line[i + 1 :], line[:i] + rng.choice("abé") + line[i:], line[:i] + "z" + line[i + 1 :]])
    return line


@pytest.mark.parametrize("tau, each", [(2, 10), (1, 3), (3, 4)])
def test_near_lines(spark, monkeypatch, tau, each):
    monkeypatch.setattr(line_dedup, "BLOCK", 5)
    rng = random.Random(tau)
    bases = ["".join(rng.choice("abcdeinrt ") for _ in range(rng.randint(1, 45))) for _ in range(25)]
    kinds = sorted({edited(rng, b, rng.randint(0, 4)) for b in bases for _ in range(7) if len(b) > 6} | set(bases))
    kinds = [k for k in kinds if k.strip()]
    df = spark.createDataFrame(list(enumerate(kinds)), "line_id bigint, line string")
    got = {tuple(r) for r in line_dedup.near_lines(df, tau, each).collect()}
    assert got == {(i, j) for i, a in enumerate(kinds) for j, b in enumerate(kinds) if i < j and near(a, b, tau, each)}


def test_large_group_of_near_copies(spark):
    """300 lines that share most of their segments: few are near, all of those are found, and few rows are made."""
    rng = random.Random(5)
    base = "all rights reserved by the authors of the harbour gazette and its heirs"
    kinds = set()
    while len(kinds) < 300:
        i = rng.randrange(len(base))
        kinds.add(base[:i] + "".join(rng.choice("abcdeinrtlmosu") for _ in range(6)) + base[i:])
    kinds = sorted(kinds | {base, base + "."})
    df = spark.createDataFrame(list(enumerate(kinds)), "line_id bigint, line string")
    got = {tuple(r) for r in line_dedup.near_lines(df).collect()}
    for i in range(0, len(kinds), 10):
        want = {tuple(sorted((i, j))) for j, b in enumerate(kinds) if near(kinds[i], b, 2, 10)}
        assert {p for p in got if i in p} == want


def test_rows_lose_their_own_lines(spark):
    once, twice = "keep me, I am the only line of this kind here", "this line stands in both rows of the document"
    rows = [(1, f"{twice}\n{once}", "a", 1, "x"), (1, f"other\n{twice}\nShare on Facebook", "b", 2, "y"), (2, "Share on Facebock\n\nYes", "c", 3, "z"), (3, "No\nYes", None, None, None), (3, "No\nYes", None, None, None), (4, None, None, None, None), (None, once, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = line_dedup.without_duplicates(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    texts = sorted((r.text for r in out.where("doc_id = 1").collect()), key=len)
    assert once in texts[0] + texts[1] and (texts[0] + texts[1]).count(twice) == 1 and "Share on Facebook" in texts[0] + texts[1]
    rest = {r.doc_id: (r.text, r.removed) for r in out.where("doc_id > 1 or doc_id is null").collect()}
    assert rest == {2: ("\nYes", "c"), 3: ("No", None), 4: (None, None), None: (once, None)}
    got = {r.doc_id: (r.n_lines, r.n_equal, r.n_near) for r in line_dedup.report(docs).collect()}
    assert got == {1: (5, 1, 0), 2: (2, 0, 1), 3: (4, 2, 0), None: (1, 1, 0)}


def test_very_long_line(spark):
    long = "".join(random.Random(1).choice("abcdeinrt ") for _ in range(50_000))
    docs = spark.createDataFrame([(1, long), (2, long[:100] + long[101:]), (3, long[5:])], "doc_id bigint, text string")
    got = {r.doc_id: (r.n_equal, r.n_near) for r in line_dedup.report(docs).collect()}
    assert got == {1: (0, 0), 2: (0, 1), 3: (0, 0)}
    assert line_dedup.report(docs.limit(0)).count() == 0 and line_dedup.without_duplicates(docs.limit(0)).count() == 0


def test_lines_that_share_much_make_no_rows_unless_they_are_near(spark, monkeypatch):
    """Copies of a line with other letters put in at one place each: what is written grows with the lines and not with their pairs."""
    rng = random.Random(6)
    base = "".join(rng.choice("etaonrishdlu ") for _ in range(80))
    copies = {base[:k] + "".join(rng.choice("bcfgjkmpqvwxyz") for _ in range(4)) + base[k:] for k in rng.choices(range(30, 80), k=60)}
    copies |= {base, base[:60] + "e" + base[60:], base[:40] + base[42:]}
    rows, cut = [], line_dedup.cut
    monkeypatch.setattr(line_dedup, "cut", lambda df, stem: (out := cut(df, stem), rows.append(out.count()))[0])
    df = spark.createDataFrame(list(enumerate(sorted(copies))), "line_id bigint, line string")
    got, ordered = {tuple(r) for r in line_dedup.near_lines(df).collect()}, sorted(copies)
    assert got == {(i, j) for i in range(len(ordered)) for j in range(i + 1, len(ordered)) if near(ordered[i], ordered[j], 2, 10)}
    assert len(got) > 0 and max(rows) <= 12 * len(ordered)


def test_letter_counts_over_31(spark):
    pairs = [("e" * 40, "e" * 50), ("e" * 31, "e" * 33), ("e" * 30 + "n" * 70, "e" * 32 + "n" * 70), ("t" * 34, "r" * 34)]
    a, b = (line_dedup._letters(F.col(c)) for c in "ab")
    found = spark.createDataFrame(pairs, "a string, b string").select(line_dedup._may_be_near(a, b, 2)).collect()
    assert [r[0] for r in found] == [False, True, True, True] and "e" in line_dedup.LETTERS
