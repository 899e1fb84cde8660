"""Phrases, periodic runs and MinHash duplicates against brute force on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tickloom.llm import lsh_forest, phrases, runs
from tickloom.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, lang string, key string, n int, root int, `order` int, f int"


def table(spark, rows):
    """Rows (doc_id, text, lang) with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "x", 1, 2, 3, None) for r in rows], SCHEMA).repartition(5)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# Phrases


def test_words_are_numbered_without_a_join(spark):
    """Rows of words and blocks, of which there are many, meet nothing: as each word has its own rows, its group can number it."""
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcdefghij") + rng.choice("klmnop") for _ in range(200)), rng.choice(["en", "fr"])) for i in range(60)]
    numbered = phrases._numbered(phrases._blocks(table(spark, rows)), 50)
    assert "Join" not in numbered._jdf.queryExecution().toString()
    found = numbered.collect()
    ids = {(r.lang, r.word): r.id for r in found}
    assert len(set(ids.items())) == len({(lang, i) for (lang, _), i in ids.items()}) == sum(r.first for r in found) and min(ids.values()) > 0
    counts = Counter((lang, w) for _, text, lang in rows for w in text.split())
    assert {k: c for k, c in counts.items() if c >= 50} == {(r.lang, r.word): r.f for r in found}
    assert all(r.id == ids[r.lang, r.word] for r in found)


def phrases_by_hand(rows, least, longest, share, top):
    pieces = defaultdict(list)
    for text, lang in rows:
        pieces["und" if lang is None else lang] += [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text))]
    out = set()
    for lang, lists in pieces.items():
        f = Counter(tuple(p[i : i + k]) for p in lists for k in range(1, longest + 1) for i in range(len(p) - k + 1))
        n = sum(map(len, lists))
        often = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        inner = {g[s : s + m] for g, a in often.items() for m in range(2, len(g)) for s in range(len(g) - m + 1) if 100 * a >= share * f[g[s : s + m]]}
        found = []
        for g in often.keys() - inner:
            score, k = min((1000 * often[g] * n // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -often[g], " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for i, (s, a, text, left, right) in enumerate(sorted(found)[:top]):
            out.add((lang, i + 1, text.decode(), -a, left, right, n, -s))
    return out


@pytest.mark.parametrize("least, longest, share, top", [(3, 5, 100, 2000), (2, 3, 100, 10), (5, 5, 70, 50), (4, 2, 100, 7)])
def test_collocations(spark, monkeypatch, least, longest, share, top):
    # Small blocks, filters and buckets, so that there are many of each.
    for name, value in (("HELD", 2000), ("MERGED", 300), ("TEXT_STEP", 3000)):
        monkeypatch.setattr(phrases, name, value)
    rng = random.Random(3)
    kinds = ["A", "b", "c", "the", "The", "é", "x1", "日本", "of", "zz", *(f"r{i}" for i in range(40))]
    gaps = [" ", " ", " ", "  ", "\t", ". ", "\n", ", ", "!"]
    text = lambda: "".join(rng.choice(kinds[: rng.choice([5, 10, 50])]) + rng.choice(gaps) for _ in range(rng.randint(0, 80)))
    rows = [(text(), rng.choice(["en", "en", "fr", None, "und"])) for _ in range(200)]
    rows += [(None, "en"), ("", None), (" \n", "xx"), ("the of a b c " * 3000, "en"), rows[0], rows[0]]
    got = phrases.collocations(table(spark, [(i, *r) for i, r in enumerate(rows)]), least, longest, share, top).collect()
    assert len({tuple(r) for r in got}) == len(got)
    assert {tuple(r) for r in got} == phrases_by_hand(rows, least, longest, share, top)


def test_collocations_of_nothing(spark):
    assert phrases.collocations(table(spark, [])).count() == 0
    assert phrases.collocations(table(spark, [(1, "a b c", "en")])).count() == 0


@pytest.mark.parametrize("n, bits, skipped", [(2, 1, 1), (2, 16, 3), (3, 7, 0), (4, 20, 5), (5, 32, 9), (5, 2, 4)])
def test_filter_gives_back_what_went_in(n, bits, skipped):
    rng = np.random.default_rng(n * bits)
    grams = phrases.Grams(n, bits)
    ids = [rng.integers(0, 1 << bits, 3000, dtype=np.uint64) for _ in range(n)]
    limbs, counts = phrases.counted(grams.permuted(ids), rng.integers(1, 600, 3000))
    bucket = (limbs[0] >> np.uint64(grams.widths[0] - skipped)).astype(np.int64)
    back = []
    for b in np.unique(bucket).tolist():
        data = phrases.build_filter([x[bucket == b] for x in limbs], counts[bucket == b], grams.widths, skipped)
        back.append(phrases.filter_entries(data, grams.widths, skipped, b))
    assert all(np.array_equal(np.concatenate([x[0][k] for x in back]), limbs[k]) for k in range(len(limbs)))
    assert np.array_equal(np.concatenate([x[1] for x in back]), counts)
    want = Counter(zip(*(x.tolist() for x in ids), strict=True)).keys()
    assert set(zip(*(x.tolist() for x in grams.restored(limbs)), strict=True)) == set(want)


def test_hot_pair_is_one_entry_of_a_filter():
    grams = phrases.Grams(2, 10)
    limbs, counts = phrases.counted(grams.permuted([np.full(100_000, 5, np.uint64), np.full(100_000, 7, np.uint64)]))
    assert counts.tolist() == [100_000] and len(phrases.build_filter(limbs, counts, grams.widths, 2)) < 64


# Runs


def runs_by_hand(w, least):
    found = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            part = w[i : i + size]
            if size >= max(least, 2 * q) and all(part[p:] != part[:-p] for p in range(1, q)):
                found.append((i, size, q))
            i = j + 1
    return sorted(found)


def test_lyndon_lengths():
    rng = random.Random(1)
    for _ in range(400):
        s = [rng.choice([0, 1, 2, 3, 1, 2]) for _ in range(rng.randint(0, 25))]
        want = []
        for i in range(len(s)):
            end = s.index(0, i) if 0 in s[i:] else len(s)
            factors = [s[i:j] for j in range(i + 1, end + 1)]
            want.append(max((len(u) for u in factors if all(u < u[k:] for k in range(1, len(u)))), default=0))
        assert runs.lyndon_lengths(s) == want


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_of_rows(least):
    rng = random.Random(least)
    for _ in range(150):
        rows = []
        for _ in range(rng.randint(1, 4)):
            s = [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 40))]
            if s and rng.random() < 0.5:
                a, p = rng.randrange(len(s)), rng.randint(1, 6)
                s += [s[a + k % min(p, len(s) - a)] for k in range(rng.randint(0, 30))]
            rows.append(s)
        start = np.cumsum([0, *map(len, rows)])
        word = np.array([x for s in rows for x in s], np.int64)
        row = np.repeat(np.arange(len(rows)), np.diff(start))
        want = sorted((int(a + start[r]), size, q) for r, s in enumerate(rows) for a, size, q in runs_by_hand(s, least))
        assert [tuple(x) for x in runs.runs_of(word, row, least).tolist()] == want


def test_periodic_runs(spark):
    long = " ".join(["x", "y", "z"] * 20_000)
    texts = [None, "", " \t\n ", "a b " * 6 + "c", "A a " * 6, "a " * 11, "a\n" * 12, long, "one two", "é ü " * 7 + "tail", "p q r " * 5 + "s " * 15]
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(3, texts[3], None), (None, texts[10], None)]
    got = runs.periodic_runs(table(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        of = [t for i, t, _ in rows if i == r.doc_id]
        assert r.n_words in {len(words(t)) for t in of}
        text = next(t for t in of if len(words(t)) == r.n_words)
        w = words(text)
        want = [(0, 60_000, 3)] if text == long else runs_by_hand(w, 12)
        assert [tuple(x) for x in r.runs] == want
        dropped = {k for a, size, q in want for k in range(a + q, a + size)}
        assert r.collapsed == " ".join(x for k, x in enumerate(w) if k not in dropped)
    assert runs.periodic_runs(table(spark, [])).count() == 0


def test_runs_query(spark, folder):
    got = {r.doc_id: r for r in QUERIES["op13_runs"](spark, folder).collect()}
    for doc_id, text in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        w = words(text)
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and w:
            a, g = h // 10 % len(w), h // 10
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        if len(w) > 1500:
            continue  # too slow by hand
        found, r = runs_by_hand(w, 12), got[doc_id]
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{size},{q}\n" for a, size, q in found).encode()).hexdigest()
        dropped = {k for a, size, q in found for k in range(a + q, a + size)}
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in dropped).encode()).hexdigest()


# MinHash


def shingles(text, size):
    w = words(lowered(text))
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def components_by_hand(rows, size=4):
    nodes = defaultdict(list)
    for doc_id, text in rows:
        nodes[shingles(text, size)].append(doc_id)
    sets = [s for s in nodes if s]
    up, seen = list(range(len(sets))), defaultdict(list)

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in seen[x])
        for x in s:
            seen[x].append(i)
        for j, c in common.items():
            if 100 * c >= 80 * (len(s) + len(sets[j]) - c):
                up[root(i)] = root(j)
    least = {}
    for i, s in enumerate(sets):
        ids = [d for d in nodes[s] if d is not None]
        least[root(i)] = min([least.get(root(i)), *ids], key=lambda x: (x is None, x or 0))
    out = Counter()
    for i, s in enumerate(sets):
        out.update((d, len(s), least[root(i)], d is not None and d == least[root(i)]) for d in nodes[s])
    out.update((d, 0, d, d is not None) for d in nodes.get(frozenset(), []))
    return out


def minhash_case(kind):
    rng = random.Random(kind)
    vocabulary = [f"w{i}" for i in range(3000)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]

    def edited(w, n):
        w = list(w)
        for _ in range(n):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        return w

    if kind == "odd":
        rows = [(i, " ".join(prose(rng.randint(0, 40)))) for i in range(60)]
        rows += [(100 + i, t + " Extra") for i, (_, t) in enumerate(rows)]
        rows += [(300, None), (301, ""), (302, " \n"), (303, "a b"), (304, "A  B"), (305, "a b c"), (None, "a b"), (None, None), (None, "only here"), rows[5], (7, rows[8][1]), (306, "w" * 50_000 + " x")]
        return [*rows, (400, " ".join(long := prose(20_000))), (401, " ".join(edited(long, 40)))]
    if kind == "copies":
        base = prose(150)
        return [(i, " ".join(edited(base, rng.choice([1, 1, 2, 3, 4])))) for i in range(800)] + [(2000 + i, " ".join(prose(rng.randint(0, 60)))) for i in range(100)]
    passage = prose(60)
    rows = [(i, passage + prose(rng.randint(5, 60))) for i in range(500)]
    rows += [(4000 + i, [*w, rng.choice(vocabulary)]) for i, (_, w) in enumerate(rows[:100])] + [(5000 + i, edited(w, 2)) for i, (_, w) in enumerate(rows[100:200])]
    return [(i, " ".join(w)) for i, w in rows]


@pytest.mark.parametrize("kind", ["odd", "copies", "passage"])
def test_near_duplicates(spark, kind):
    rows = minhash_case(kind)
    got = lsh_forest.near_duplicates(table(spark, [(*r, None) for r in rows])).collect()
    assert Counter(tuple(r) for r in got) == components_by_hand(rows)


def test_near_duplicates_of_a_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    assert Counter(tuple(r) for r in QUERIES["op12_minhash"](spark, folder).collect()) == components_by_hand([tuple(r) for r in docs.collect()])
    assert lsh_forest.near_duplicates(table(spark, [])).count() == 0


def test_neighbours_across_ranges(spark):
    """Copies of one text with small edits over many small ranges: links across the cuts are found."""
    rows = minhash_case("copies")[:300]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        got = lsh_forest.near_duplicates(table(spark, [(*r, None) for r in rows])).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert Counter(tuple(r) for r in got) == components_by_hand(rows)
