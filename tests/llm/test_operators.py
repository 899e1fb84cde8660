"""The training-data operators against brute force on small tables, with NULLs, empty texts, repeats and empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from check import connect, differences
from tickloom.llm import context_mixing, decontaminate, html_text, kneser_ney, line_dedup, mixing, quotes, simhash, spotsigs, token_file
from tickloom.llm.html_labels import unmarked
from tickloom.llm.queries import ORACLE, QUERIES, byte_bpe
from tickloom.session import scratch_path

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _key string, copy int"
WORDS = "the of and ferry harbour goats strait bridge mill flour valley beetle winter spring stone rope lamp river".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "er", ","]) for _ in range(n))


def corpus(spark, n=40, odd=True):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randint(1, 120)), rng.choice(["en", "fr"]), f"s{i % 3}", 0, "x", 1) for i in range(n)]
    rows[7] = (7, rows[3][1], "en", "s0", 0, None, None)
    rows[9] = (9, rows[4][1] + " extra", None, None, None, "x", 2)
    if odd:
        rows += [(n, None, "en", "s1", None, None, None), (n + 1, "", "en", "s1", 0, "", 0), (n + 2, " \n\t ", None, "s1", 3, "", 0), rows[5], (n + 3, "w" * 5000 + " end", "en", "s1", 0, "", 0)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, folder, name):
    assert differences(QUERIES[name](spark, folder).toPandas(), connect(folder).sql(ORACLE[name]).df()) == []


def test_main_text():
    tree = html_text.train()
    page = (
        "<html><body><nav><a href=/>Home</a></nav><div class='cookie-banner'>We use cookies.</div><article><h1>A &amp; B</h1>"
        "<p>One <i>two</i>\n three<br>four</p><p>Short.</p><aside>Ad</aside><script>var x='<p>no</p>'</script></article>"
        "<section id=comments><p>I like it.</p></section><footer>F</footer></body></html>"
    )
    assert html_text.main_text(page, tree) == "A & B\nOne two three four\nShort."
    assert html_text.main_text(None, tree) == html_text.main_text("", tree) == html_text.main_text("<p", tree) == ""
    for labelled, wanted in html_text.labelled_pages():
        found = html_text.blocks(labelled)
        assert [b.text in wanted for b in found] == tree.predict(html_text.features(found)).tolist()


def test_main_text_of_ordinary_markup():
    tree, body = html_text.train(), "<h1>T</h1><p>First words of it.</p><p>Second words of it.</p>"
    want = "T\nFirst words of it.\nSecond words of it."
    for page in (
        f'<article title="The hidden valley">{body}</article>',
        f'<article data-state="hidden" aria-label="hidden">{body}</article>',
        f"<article><h1>T</h1><p data-x=it's>First words of it.</p><p>Second words of it.</p></article>",
        f'<article data-a="x > y" data-b=\'a "b" <c>\'>{body}</article>',
        f'<div class="layout has-sidebar"><article>{body}</article><div class="sidebar"><p>More to read.</p></div></div>',
        f'<div class="sidebar-layout header"><main>{body}</main></div>',
        f'<div class="banner-page"><article class="post">{body}</article><div class="widget"><article><h2>Teaser</h2></article></div></div>',
        f'<main>{body}<section class="comments"><article><p>I was there too.</p></article></section></main>',
        f'<div hidden><p>Not seen.</p></div><div style="display : none">Nor this.</div><article>{body}</article>',
        f'<article class="a" class="ad">{body}</article>',
        "<article><h1>T</h1><p>First <a href=/a>words</a> of it.</p><p><a href=/b>Second words</a> of it now.</p></article>".replace(" now", ""),
    ):
        assert html_text.main_text(page, tree) == want, page
    assert html_text.attributes(""" Class='a &amp; b' HIDDEN data-x=it's id = "q" id=r""") == {"class": "a & b", "hidden": "", "data-x": "it's", "id": "q"}
    long_page = "<article>" + "<p>A paragraph of seven words, every time.</p>" * 30_000 + "</article>"
    assert html_text.main_text(long_page, tree).count("\n") == 29_999


def test_main_text_without_marks():
    """Pages of other texts than the labelled ones, in which only the neighbours tell."""
    rng = random.Random(11)

    def sentence(n):
        return " ".join(rng.choice(WORDS) for _ in range(n)) + "."

    right = total = 0
    tree = html_text.train()
    for k in range(200):
        texts = [tuple({sentence(rng.randint(*span)) for _ in range(8)}) for span in ((14, 40), (1, 7), (2, 5), (1, 3), (2, 9))]
        page, wanted = unmarked(k, *texts)
        for b, keep in zip(found := html_text.blocks(page), tree.predict(html_text.features(found)), strict=True):
            right += (b.text in wanted) == keep
            total += 1
    assert right / total > 0.95
    shape = set(html_text.FEATURES[:6])
    assert {html_text.FEATURES[f] for f in tree.feature if f >= 0} & shape >= {"link_density"} and len({html_text.FEATURES[f] for f in tree.feature if f >= 0} & shape) > 2


def test_main_text_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<article><p>é</p></article>", "x"), (None, None, None, "x"), (1, "u", "", "x")], "page_id bigint, url string, html string, text string")
    rows = sorted(html_text.extract(pages).collect(), key=str)
    assert [(r.page_id, r.text, r.n_chars) for r in rows] == [(1, "", 0), (1, "é", 1), (None, "", 0)]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_mixing(spark):
    docs = corpus(spark, 300)
    out = mixing.mix_sources(docs, epochs=3.0).toPandas()
    again = mixing.mix_sources(docs.repartition(5), epochs=3.0).toPandas()
    assert sorted(out.mix_key) == sorted(again.mix_key)
    rates = {r.source: r.rate for r in mixing.source_rates(docs, epochs=3.0).collect()}
    got = out[out.source == "s1"].shape[0] / docs.where("source = 's1'").count()
    assert abs(got - rates["s1"]) < 5 * math.sqrt(rates["s1"] / 100)
    assert mixing.mix_sources(empty(spark)).count() == 0
    assert mixing.mix_sources(docs, weights={"none": 1.0}).count() == 0
    big = mixing.mix_sources(docs, epochs=400.0).groupBy("doc_id", "source").count().where("source = 's0'").agg(F.avg("count")).first()[0]
    assert big > 100


def test_spotsigs(spark):
    docs = corpus(spark)
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (-r[0], r[1]))
    got = spotsigs.compare_with_next(docs).toPandas()
    assert len(got) == len(rows)
    want = []
    for (i, x), (_, y) in zip(rows, rows[1:] + rows[:1], strict=True):
        k = len(x) // 2
        want.append((i, len(x), hashlib.sha256((x[: len(x) - k] + y[:k]).encode()).hexdigest()))
    assert sorted(zip(got.doc_id, got.n_chars, got.edited_sha256, strict=True)) == sorted(want)
    prints = dict(zip(got.doc_id, got.fingerprint, strict=True))
    assert prints[7] == prints[3] and got.near_edited.between(0, 1).all() and got.near_next.between(0, 1).all()
    assert spotsigs.compare_with_next(empty(spark)).count() == 0
    pairs, members = spotsigs.near_pairs(docs, 0.5)
    sets = {r.doc_id: set(r.spots) for r in spotsigs.fingerprints(docs).collect()}
    named = {r.doc_id: r.class_id for r in members.collect()}
    ids = sorted(set(named.values()))
    near = {(a, b) for a in ids for b in ids if a < b and sets[a] and len(sets[a] & sets[b]) >= 0.5 * len(sets[a] | sets[b])}
    assert {(r.a, r.b) for r in pairs.collect()} == near


def test_decontamination(spark):
    rng = random.Random(2)
    item = " ".join(f"word{rng.randint(0, 10**6)}" for _ in range(30)).split()
    changed = [w if i % 9 != 4 else "other" for i, w in enumerate(item)]
    texts = [" ".join(["lead"] * 3 + item + ["tail"]), " ".join(changed), " ".join(item[:9]), "clean text of the harbour", None, "", " ".join(item[10:25]).upper()]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, item_id string")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, ""), (4, "the of"), (None, "a b c d e f")], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): r.n_equal for r in decontaminate.find_overlaps(docs, bench).collect()}
    assert set(found) == {(0, 1), (1, 1), (6, 1)} and found[(0, 1)] == 30
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()) == [2, 3, 4, 5]
    assert decontaminate.find_overlaps(docs, bench.limit(0)).count() == 0


def test_decontamination_of_long_items(spark):
    """Overlaps of long items are found whole, whatever their place; the same item twice counts once."""
    item = [f"item{k}" for k in range(1500)]
    changed = [w if k % 9 else f"other{k}" for k, w in enumerate(item)]
    texts = {0: ["lead", *item, "tail"], 1: item[100:1300], 2: [*changed[301:1201], "end"], 3: item[700:712], 4: item[600:700] + ["gap"] * 200 + item[900:1400]}
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in texts.items()], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, " ".join(item)), (1, " ".join(item)), (None, " ".join(item[:20]))], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): (r.doc_start, r.item_start, r.n_words, r.n_equal, r.item_words) for r in decontaminate.find_overlaps(docs, bench).collect()}
    assert found == {
        (0, 1): (1, 0, 1500, 1500, 1500), (1, 1): (0, 100, 1200, 1200, 1500), (2, 1): (0, 301, 900, 800, 1500),
        (4, 1): (300, 900, 500, 500, 1500), (0, None): (1, 0, 20, 20, 20)}


def longest(equal):
    """(equal words, -words) of the best stretch of which over 4/5 are equal, by brute force."""
    found = [(sum(equal[i:j]), i - j) for i in range(len(equal)) for j in range(i + 1, len(equal) + 1) if 5 * sum(equal[i:j]) > 4 * (j - i)]
    return max(found, default=(0, 0))


def test_decontamination_of_substituted_words(spark):
    rng, cases = random.Random(3), []
    for n in range(15, 21):
        places = [(i,) for i in range(n)] + [(i, j) for i in range(n) for j in range(i)]
        places += [tuple(rng.sample(range(n), rng.randint(3, 5))) for _ in range(60)]
        cases += [(n, [k not in changed for k in range(n)]) for changed in places]
    # The longest gap that 12 equal words on both sides pay for, and runs no mask of ten or more words fits into.
    cases += [(29, [not 12 <= k < 17 for k in range(29)]), (30, [not 12 <= k < 18 for k in range(30)]), (16, [k not in (4, 8, 12) for k in range(16)])]
    items = {n: [f"item{n}x{k}" for k in range(n)] for n, _ in cases}
    texts = [(d, " ".join(["lead", *(w if same else f"other{k}" for k, (w, same) in enumerate(zip(items[n], equal, strict=True))), "tail"])) for d, (n, equal) in enumerate(cases)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id bigint, text string")
    best = {d: longest(equal) for d, (_, equal) in enumerate(cases)}
    want = {(d, cases[d][0]): b for d, b in best.items() if b[0] >= 13}
    assert {(r.doc_id, r.item_id): (r.n_equal, -r.n_words) for r in decontaminate.find_overlaps(docs, bench).collect()} == want
    assert {r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()} == {d for d, b in best.items() if b[0] < 13}


def test_kneser_ney(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, 80), "en", "s", 0, "x", 1) for i in range(60)] + [(100 + i, " ".join("".join(rng.choice("#%&xyz") for _ in range(6)) for _ in range(60)), "en", "s", 0, "x", 1) for i in range(5)]
    rows += [(200, None, "en", None, None, None, None), (201, "", None, None, None, None, None), (202, prose(rng, 50), None, "s", 0, "x", 1)]
    docs, labels = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id bigint, quality int, toxic int")
    judged = {r.doc_id: r.keep for r in kneser_ney.judge(docs, labels).collect()}
    assert all(judged[i] for i in range(60)) and not any(judged[100 + i] for i in range(5)) and judged[202] and not judged[200] and not judged[201]
    kept = kneser_ney.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, keep in judged.items() if keep}
    assert all(r.keep for r in kneser_ney.judge(docs.where("doc_id < 100"), labels.limit(0)).collect())
    assert kneser_ney.judge(empty(spark), labels).count() == 0
    model = kneser_ney.fit(docs.where("doc_id < 60"))
    h = [np.array([x], np.uint64) for x in kneser_ney.Words(pa.array(["the of ferry"])).hashes()]
    vocabulary = np.concatenate([model.uni[0]])
    total = sum(10 ** model.score(h[0], h[1], vocabulary[k : k + 1])[0] for k in range(len(vocabulary))) + 10**model.unknown
    assert total == pytest.approx(1.0, abs=0.02)


def test_kneser_ney_counts_all_trusted_documents(spark, monkeypatch):
    """Scores are those of a model in memory of all trusted documents, and of all others for a trusted one; no size is left out."""
    monkeypatch.setattr(kneser_ney, "BUCKET", 4000)
    monkeypatch.setattr(kneser_ney, "BLOCK", 5000)
    monkeypatch.setattr(kneser_ney, "COUNTED", 3000)
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randint(0, 90)) + (f" only{i} here{i}" if i % 5 else ""), "en", "s", 0, "x", 1) for i in range(80)]
    rows += [rows[41], (41, "another row of a trusted id", "en", "s", 0, "x", 1), (90, None, "en", "s", 0, "x", 1), (None, rows[3][1], None, "s", 0, "x", 1)]
    docs, labels = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(i, 1, 0) for i in range(45)] + [(44, 0, 0), (200, 1, 0)], "doc_id bigint, quality int, toxic int")
    model = kneser_ney.fit(docs.where("doc_id < 44"))
    got = kneser_ney.score(docs, labels).collect()
    assert len(got) == len(rows) and {r.doc_id for r in got if r.lm_trusted} == set(range(44))
    inside = {}
    for r in got:
        u, v, w, _ = kneser_ney._trigrams(kneser_ney.Words(pa.array([r.text or ""]), lower=False))
        inside[r.doc_id, r.text] = model.score(u, v, w).sum()
        assert r.lm_words == len(u)
        if not r.lm_trusted:
            assert r.lm_log10 == pytest.approx(inside[r.doc_id, r.text], rel=1e-5, abs=1e-6)
    alone = [r for r in got if r.lm_trusted and f"only{r.doc_id}" in r.text]
    assert alone and all(r.lm_log10 < inside[r.doc_id, r.text] - 1 for r in alone)
    # Its own words are as unknown to a trusted document as they are to a copy of it in a model without it.
    without = kneser_ney.score(docs, labels.where("doc_id <> 8")).where("doc_id = 8").first()
    assert next(r.lm_log10 for r in got if r.doc_id == 8) == pytest.approx(without.lm_log10, rel=0.05)


def test_token_file(spark):
    from tokenizers import Tokenizer

    odd = ["a  b", "a\n\nb", "a\n b", " a", "a ", "a\n", "\n", "", None, "a\tb c", "a b c", "don't we've 12!!", "é à\nx y", "<|endoftext|> x"]
    docs = corpus(spark).select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(odd, 1000)), "doc_id bigint, text string"))
    path = scratch_path(spark, "test-tokens")
    token_file.write_token_file(docs, path, byte_bpe())
    got = sorted(token_file.read_token_file(spark, path).collect(), key=lambda r: r.start)
    tokenizer, start = Tokenizer.from_file(byte_bpe()), 0
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()))
    assert len(rows) == len(got)
    for (i, text), r in zip(rows, got, strict=True):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids, r.ids_crc32) == (i, start, len(ids), ids, zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    ranks = np.array([0, 255, 256, 65535, 65536, 2**24, 2**32 - 1], np.uint32)
    control, data = token_file.pack(ranks)
    assert token_file.unpack(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(ranks)).tolist() == ranks.tolist()


def test_context_mixing(spark):
    docs = corpus(spark, 60)
    rows = [(r.doc_id, [*words(r.text), None]) for r in docs.collect()]
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    c = Counter(w for i, ws in rows if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    got = context_mixing.score(docs).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        ws = texts[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(ws), sum(c[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) and r.score < 0
    assert context_mixing.score(empty(spark)).count() == 0


def test_mixing_weights_come_from_all_training_words(spark, monkeypatch):
    """Two thirds of a megabyte, of which no part is left out, whatever its size."""
    rng = random.Random(4)
    docs = spark.createDataFrame([(i, " ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(800))) for i in range(100)], "doc_id long, text string")
    given, learn = [], context_mixing._mixed_weights

    def seen(words, kinds, counts):
        given.append(words.agg(F.sum("c")).first()[0])
        weights = learn(words, kinds, counts)
        half = learn(words.where("token % 2 = 0"), kinds, counts)
        assert weights.shape == half.shape and np.isfinite(weights).all() and (weights != half).any()
        return weights

    monkeypatch.setattr(context_mixing, "_mixed_weights", seen)
    assert given == [r.train_tokens for r in context_mixing.score(docs).limit(1).collect()]


def test_rare_words_count_in_every_context(spark, monkeypatch):
    """Words that are fewer than one in two millions keep their own counts, whatever else the corpus holds."""
    rng, context = random.Random(8), len(context_mixing.BITS) - 1
    rare = sorted({"".join(rng.choices("bcdefgh", k=rng.randint(1, 6))) for _ in range(400)})
    docs = spark.createDataFrame([(-1, "a " * 2_300_000), *enumerate(rare)], "doc_id long, text string")
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in range(-1, len(rare))}
    assert not held[-1] and any(held.values())
    weights = np.zeros((context_mixing.CONFIDENCE**2, len(context_mixing.BITS)), np.float32)
    weights[:, context] = 1  # the predictor by the word so far alone
    monkeypatch.setattr(context_mixing, "_mixed_weights", lambda *_: weights)
    counts = Counter({"a ": 2_300_000, "\n": len(rare) + 1 - sum(held.values())}) + Counter(f"{x} " for i, x in enumerate(rare) if not held[i])
    nodes = Counter()
    for word, c in counts.items():
        bits = "".join(f"{b:08b}" for b in word.encode())
        for k in range(len(bits) + 1):
            nodes[bits[:k]] += c

    def log10(word):
        bits = "".join(f"{b:08b}" for b in word.encode())
        return sum(math.log10((nodes[bits[: k + 1]] + 0.4) / (nodes[bits[:k]] + 0.8)) for k in range(len(bits)))

    first = 1 / (1 + 2 * math.exp(-2))  # share of a text's first word that its own probability has in the memory of the text
    got = {r.doc_id: r.score for r in context_mixing.score(docs).where("doc_id >= 0").collect()}
    assert got == pytest.approx({i: log10(f"{x} ") + math.log10(first) + log10("\n") for i, x in enumerate(rare)}, rel=1e-4)


def test_contexts_of_several_blocks_are_counted_whole(spark, monkeypatch):
    rng = random.Random(9)
    docs = spark.createDataFrame([(i, " ".join("".join(rng.choices("abcé", k=rng.randint(1, 5))) for _ in range(40))) for i in range(60)], "doc_id long, text string")
    monkeypatch.setattr(context_mixing, "_mixed_weights", lambda *_: np.full((context_mixing.CONFIDENCE**2, len(context_mixing.BITS)), 0.3, np.float32))
    whole = {r.doc_id: r.score for r in context_mixing.score(docs).collect()}
    for size in (300, 20):
        monkeypatch.setattr(context_mixing, "BLOCK", size)
        monkeypatch.setattr(context_mixing, "PACK", 2000)
        monkeypatch.setattr(context_mixing, "BUCKET", 3000)
        assert {r.doc_id: r.score for r in context_mixing.score(docs).collect()} == pytest.approx(whole, rel=1e-5)


def test_recall_counts_earlier_words():
    rng = np.random.default_rng(2)
    rows = np.array([0, 0, 5, 6, 400, 900, 900])
    number = rng.integers(0, 12, 900)
    number[6:400] = np.arange(394) % 3
    row = np.repeat(np.arange(6), np.diff(rows))
    share, after = context_mixing._recall(number, row, rows)
    for i in range(900):
        before = number[rows[row[i]] : i].tolist()
        assert share[i] == pytest.approx(before.count(number[i]) / max(len(before), 1))
        followers = [b for a, b in zip(before[:-1], before[1:]) if a == before[-1]] if before else []
        assert after[i] == pytest.approx(followers.count(number[i]) / len(followers) if followers else 0.0)


def test_words_are_scored_once_a_task(monkeypatch):
    """Remembered scores stay in order as words are added, and only new ones are looked at."""
    mixer, seen = context_mixing.Mixer([], []), []
    monkeypatch.setattr(mixer, "log10_words", lambda data, offsets: seen.append(len(offsets) - 1) or np.array([data[i:j].sum() for i, j in zip(offsets[:-1], offsets[1:])], float))
    scores, rng = context_mixing._Scores(mixer), random.Random(6)
    for _ in range(20):
        text = " ".join("".join(rng.choices("abcd", k=rng.randint(1, 3))) for _ in range(30))
        w = context_mixing.Words(pa.array([text]))
        kinds, at, number = np.unique(w.hashes(), return_index=True, return_inverse=True)
        assert scores(w, kinds, at)[number].tolist() == [float(sum((x + " ").encode())) for x in text.split()]
    assert sum(seen) == len(scores.known) and (np.diff(scores.known.astype(object)) > 0).all()


def test_words_have_probability_one():
    mixer = context_mixing._learn([(np.zeros(1 << b, np.float32),) * 2 for b in context_mixing.BITS], *context_mixing._closed(*context_mixing.raw(pa.array([b"ab", b""]))), np.ones(2))
    one = sum(10 ** mixer.log10_words(np.array([b, 0x20], np.uint8)[:1], np.array([0, 1]))[0] for b in range(256))
    assert one == pytest.approx(1.0, abs=1e-6)


@pytest.mark.parametrize("tau", [1, 2, 3])
def test_bit_parallel_distance(spark, tau):
    rng, pairs = random.Random(tau), []
    for _ in range(300):
        a = [rng.choice("abé") for _ in range(rng.randint(4, 30))]
        b = list(a)
        for _ in range(rng.randint(0, tau + 2)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "cb"])
        a, b = sorted(("".join(a), "".join(b)), key=len)
        if a and len(b) - len(a) <= tau:
            pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a string, b string").withColumn("w", line_dedup.within(F.col("a"), F.col("b"), tau))
    assert df.where(F.col("w") != (F.levenshtein("a", "b") <= tau)).count() == 0


def test_line_dedup(spark):
    a, b = "the ferry left the harbour at dawn", "the ferry left the harbor at dawn."
    docs = spark.createDataFrame([(2, f"{a}\nshort\n\n{b}", "x"), (1, f" {b}\nshort", "x"), (3, None, "x"), (4, "", "x"), (None, a, "x")], "doc_id bigint, text string, removed string")
    got = {r.doc_id: (r.n_lines, r.n_equal, r.n_near, r.removed) for r in line_dedup.report(docs).collect()}
    assert got == {1: (2, 0, 0, []), 2: (3, 2, 1, [0, 1, 3]), None: (1, 1, 0, [0])}
    assert {r.doc_id: r.text for r in line_dedup.without_duplicates(docs).collect()}[2] == ""
    assert line_dedup.report(docs.limit(0)).count() == 0


def test_quotes(spark):
    rows = [
        (1, 0, "user", "Hello there.\nWhat is a ferry?"), (1, 1, "assistant", "A boat that\ncrosses water."), (1, 2, "user", "> A boat that crosses\n> water.\nThanks!"),
        (1, 3, "user", "On Monday X wrote:\n> hello THERE\n>> nothing\nBack to the start."), (1, 4, "assistant", "goes on"), (1, 5, "assistant", "> Thanks!\nlate reply"),
        (1, 6, "x", "> Back to the start.\ndeep"), (1, 7, None, None), (2, 5, "user", "> unknown\nhi"), (2, 5, "user", "> unknown\nhi"), (None, 1, "a", "> q\nno conversation"), (3, None, "a", "no turn"),
    ]
    got = quotes.reply_order(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()
    one = sorted((r for r in got if r.conv_id == 1), key=lambda r: r.reply_path)
    assert [r.turn for r in one] == [0, 1, 2, 5, 3, 4, 6, 7] and {r.turn: r.reply_to for r in one} == {0: None, 1: 0, 2: 1, 3: 0, 4: 3, 5: 2, 6: 3, 7: 6}
    assert [r.text for r in one if r.turn in (3, 5)] == ["late reply", "Back to the start."] and len(got) == len(rows)


def test_trimmed_and_rewrapped_quotes(spark):
    one_line = "The ferry left at dawn. It carried forty goats! Nobody knows why the captain turned back before the strait."
    wrapped = "Dear all,\n\nthe mill at the valley\nstopped last winter, and\nthe flour is gone\n\nthe lamp by the bridge\nhas been out since"
    rows = [
        (0, one_line), (1, wrapped), (2, "noise"), (3, "> It carried forty goats!\nfour"), (4, "> the mill at the valley stopped last\n> winter, and the flour is gone\nyes"),
        (5, "> knows why the captain turned back before the strait\nmaybe"), (6, "> goats! Nobody\nshort"), (7, "> Well, nobody knows why the captain turned back before the end\nedited"),
        (8, "> the bridge has\n> been out\nlamp"), (9, "> never said by anybody\nnone"), (10, "> It carried forty goats!\n> knows why\nparts"), (11, "> noise\n>> the flour is\n>> gone\nlevels"), (12, "> ferr\nno word"),
    ]
    got = {r.turn: (r.reply_to, r.quoted) for r in quotes.reply_order(spark.createDataFrame([(1, t, "u", x) for t, x in rows], "conv_id bigint, turn bigint, role string, text string")).collect()}
    want = {0: (None, 0), 1: (0, 0), 2: (1, 0), 3: (0, 1), 4: (1, 1), 5: (0, 1), 6: (0, 1), 7: (0, 1), 8: (1, 1), 9: (8, 0), 10: (0, 1), 11: (2, 2), 12: (11, 0)}
    assert got == want


def test_simhash(spark):
    docs = corpus(spark)
    got = simhash.near_components(simhash.fingerprints(docs), 12).collect()
    prints = {}
    for r in docs.collect():
        w = [x.encode() for x in words(r.text)]
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
        prints[r.doc_id] = sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))
    assert {r.doc_id: r.f0 % 2**64 for r in got} == prints
    label = {i: i for i in prints}
    for _ in prints:
        for i in prints:
            label[i] = min(label[j] for j in prints if (prints[i] ^ prints[j]).bit_count() <= 12)
    assert {r.doc_id: r.component_id for r in got} == label and simhash.fingerprints(empty(spark)).count() == 0
    kept = simhash.one_of_each(docs)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns and len(ids) == len(set(ids)) and 3 in ids and 7 not in ids


def test_one_of_each_verifies_links(spark):
    rng = random.Random(11)
    base, rows = [], []
    for _ in range(6):
        text = [f"w{rng.randint(0, 10**6)}" for _ in range(200)]
        base.append(text)
        for _ in range(12):
            other = list(text)
            at = rng.randint(0, 190)
            for k in range(at, min(at + rng.choice([1, 3, 20, 26, 30, 40, 60]), 200)):
                other[k] = f"x{rng.randint(0, 10**6)}"
            rows.append(" ".join(other))
    # Fingerprints alike by a repeated passage, texts that are not; and one passage once and twice.
    rows += [" ".join(["a b c d e"] * 40 + [f"u{k}x{j}" for j in range(60)]) for k in range(4)] + [" ".join(base[0]), "one two three four five six", "one two three four five six", "one two", "one three"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")

    def shingles(text):
        w = words(text)
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    sets = [shingles(r) for r in rows]
    alike = [[len(a & b) / len(a | b) for b in sets] for a in sets]
    assert sum(0.65 < alike[i][j] < 0.8 for i in range(len(rows)) for j in range(i)) > 20
    label = list(range(len(rows)))
    for _ in rows:
        label = [min(label[j] for j in range(len(rows)) if alike[i][j] >= 0.8) for i in range(len(rows))]
    assert sorted(r.doc_id for r in simhash.one_of_each(docs).collect()) == sorted(set(label))


def test_one_of_each_finds_all_links(spark, monkeypatch):
    """Texts at just 0.8, of a handful of shingles or many, whatever their fingerprints; a passage that all share links none."""
    rng, rows = random.Random(12), []
    word = lambda: f"w{rng.randint(0, 10**9)}"
    for n in (9, 9, 9, 9, 14, 14, 19, 44) * 6:
        text = [word() for _ in range(n)]
        sets = n - 4
        rows += [text, text[: 4 + math.ceil(0.8 * sets)], text[: 3 + math.ceil(0.8 * sets)]]
    passage = [word() for _ in range(30)]
    rows += [passage + [word() for _ in range(rng.randint(6, 9))] for _ in range(40)]
    docs = spark.createDataFrame([(i, " ".join(r)) for i, r in enumerate(rows)], "doc_id bigint, text string")
    sets = [{tuple(r[i : i + 5]) for i in range(max(1, len(r) - 4))} for r in rows]
    label = list(range(len(rows)))
    near = [[j for j in range(len(rows)) if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])] for i in range(len(rows))]
    for _ in range(4):
        label = [min(label[j] for j in near[i]) for i in range(len(rows))]
    for entries, pairs in ((1 << 20, 1 << 21), (100, 50)):
        monkeypatch.setattr(simhash, "ENTRIES", entries, raising=False)
        monkeypatch.setattr(simhash, "PAIRS", pairs, raising=False)
        assert sorted(r.doc_id for r in simhash.one_of_each(docs).collect()) == sorted(set(label))


def test_stages_keep_clashing_columns(spark, folder):
    names = ["_doc_id", "_text_hash", "text_hash", "component_id", "doc", "a.b", "key", "mix_note"]
    docs = corpus(spark).drop("copy").withColumns({n: F.lit(777) for n in names if n != "a.b"}).withColumn("a.b", F.lit(777))
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {tuple(r[n] for n in names) for r in kept.collect()} == {(777,) * len(names)}
    assert simhash.one_of_each(docs.limit(0)).count() == 0
    repeated = corpus_pipeline.mixed(spark, docs, folder)
    assert repeated.columns == docs.columns and {r["a.b"] for r in repeated.collect()} == {777}
    good = corpus_pipeline.good(spark, docs, folder)
    assert good.columns == docs.columns and corpus_pipeline.good(spark, docs.limit(0), folder).count() == 0
    assert corpus_pipeline.unseen(spark, docs, folder).columns == docs.columns
    assert corpus_pipeline.tokens(spark, docs, folder).count() == docs.count()


def test_verified_pairs_replace_a_false_link():
    # Only 0 - 2 and 1 - 3 are 0.8 or more alike (97 of 103); 0 - 1, at 85 of 115, must not stand for either.
    shingles = [np.arange(0, 100), np.arange(15, 115), np.arange(3, 103), np.arange(18, 118)]
    block = {"key": np.arange(4), "n": np.full(4, 100), "joined": np.arange(4), "prints": np.zeros((4, 4), np.uint64), "shingles": shingles}
    assert set(simhash._verified_pairs(block, block, 51, 0.8, True)) == {(0, 2), (1, 3)}


def test_near_components_on_chains(spark):
    from tickloom.llm.components import components

    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101), (101, 100)], "a bigint, b bigint")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100}


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    out = corpus_pipeline.run(spark, folder).toPandas().sort_values("start")
    assert (out.start.to_numpy() == np.concatenate([[0], np.cumsum(out.n_tokens)[:-1]])).all() and set(out.doc_id) <= {r.doc_id for r in docs.collect()}
