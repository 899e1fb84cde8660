"""Phrases that occur more often than their parts let expect, counted losslessly in counting quotient filters.

Words that occur often enough to be part of a phrase get dense ids. An n-gram is the n ids put together; an invertible
permutation spreads it evenly over all numbers of that width. Its highest bits are the quotient, the rest is kept in full
as the remainder, so a filter gives back exactly the n-grams and counts that went in. Each task makes filters of its own
blocks of text, cut into buckets by the highest bits; the filters of a bucket are sorted and are merged elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.bitmaps import BITS, bitmap, marked
from tickloom.llm.words import U64, Words, batches, mix
from tickloom.session import cut

TEXT_STEP = 4 << 20  # bytes of text in a block
HELD = 6_000_000  # 64-bit numbers of n-grams that a task holds before it makes filters
MERGED = 2_000_000  # n-grams of a bucket, about
NUMBERING = 1024  # groups in which words of a language are numbered

_PIECE = np.zeros(256, bool)
_PIECE[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_PARTING = _PIECE.copy()
_PARTING[[0x20, 0x09]] = True


class Grams:
    """The n-grams of n word ids of `bits` bits each as limbs: arrays of numbers, two words in each, the first word highest."""

    def __init__(self, n: int, bits: int):
        if bits > 32:
            raise ValueError("more than 2^32 different words occur often")
        self.n, self.bits, self.mask = n, U64(bits), U64((1 << bits) - 1)
        #: Bits of each limb.
        self.widths = [bits * min(2, n - k) for k in range(0, n, 2)]

    def _rounds(self) -> list[tuple[int, int]]:
        return [(r, k) for r in range(3) for k in range(self.n)]

    def _step(self, ids: list[np.ndarray], turn: int, k: int) -> None:
        """Change word k by a hash of the others: done again, it is undone."""
        total = np.full(len(ids[0]), turn * self.n + k + 1, np.uint64)
        for j, x in enumerate(ids):
            if j != k:
                total = (total + x + U64(j)) * U64(0xD6E8FEB86659FD93)
                total ^= total >> U64(29)
        ids[k] = ids[k] ^ (mix(total) & self.mask)

    def permuted(self, ids: list[np.ndarray]) -> list[np.ndarray]:
        """Limbs of the permuted n-grams."""
        ids = list(ids)
        for turn, k in self._rounds():
            self._step(ids, turn, k)
        return [ids[k] << self.bits | ids[k + 1] if k + 1 < self.n else ids[k] for k in range(0, self.n, 2)]

    def restored(self, limbs: list[np.ndarray]) -> list[np.ndarray]:
        """The ids that permuted() was given."""
        ids = []
        for k, limb in enumerate(limbs):
            ids += [limb >> self.bits, limb & self.mask] if 2 * k + 1 < self.n else [limb]
        for turn, k in reversed(self._rounds()):
            self._step(ids, turn, k)
        return ids


def counted(limbs: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """(limbs in order without repeats, their counts)."""
    if not len(limbs[0]):
        return limbs, np.zeros(0, np.int64)
    order = np.argsort(limbs[0], kind="stable") if len(limbs) == 1 else np.lexsort(limbs[::-1])
    limbs = [x[order] for x in limbs]
    first = np.zeros(len(order), bool)
    first[0] = True
    for x in limbs:
        first[1:] |= x[1:] != x[:-1]
    at = np.flatnonzero(first)
    sums = np.diff(np.append(at, len(order))) if counts is None else np.add.reduceat(counts[order], at)
    return [x[at] for x in limbs], sums


def _columns(values: np.ndarray, width: int) -> bytes:
    """Numbers of `width` bits, as many bytes of each as they need."""
    size = -(-width // 8)
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def _numbers(data: np.ndarray, n: int, width: int) -> np.ndarray:
    size = -(-width // 8)
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :size] = data[: n * size].reshape(n, size)
    return wide.view("<u8").ravel().astype(np.uint64)


def build_filter(limbs: list[np.ndarray], counts: np.ndarray, widths: list[int], skipped: int) -> bytes:
    """A counting quotient filter of n-grams in order that agree in the highest `skipped` bits.

    The next q bits of the first limb are the quotient: 2^q bits tell which quotients occur, a bit for each entry whether it
    is the last of its quotient. Remainders follow in whole bytes, then counters of one byte, of which 255 stands for a
    number of eight bytes behind them.
    """
    n = len(counts)
    q = min(max(int(n).bit_length() - 1, 0), widths[0] - skipped)
    rest = widths[0] - skipped - q
    own = limbs[0] & U64((1 << (widths[0] - skipped)) - 1)
    quotient = (own >> U64(rest)).astype(np.int64)
    occupied = np.zeros(1 << q, bool)
    occupied[quotient] = True
    run_end = np.ones(n, bool)
    run_end[:-1] = quotient[1:] != quotient[:-1]
    large = counts >= 255
    parts = [np.array([n, q, np.count_nonzero(large)], "<i8").tobytes(), np.packbits(occupied).tobytes(), np.packbits(run_end).tobytes()]
    parts.append(_columns(own & U64((1 << rest) - 1), rest))
    parts += [_columns(x, w) for x, w in zip(limbs[1:], widths[1:], strict=True)]
    return b"".join([*parts, np.where(large, 255, counts).astype(np.uint8).tobytes(), counts[large].astype("<i8").tobytes()])


def filter_entries(data: bytes, widths: list[int], skipped: int, bucket: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(limbs in order, counts) that build_filter() was given, `bucket` being the highest bits they agree in."""
    n, q, large = np.frombuffer(data, "<i8", 3).tolist()
    at, rest = 24, widths[0] - skipped - q

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return np.frombuffer(data, np.uint8, size, at - size)

    quotients = np.flatnonzero(np.unpackbits(take(-(-(1 << q) // 8)), count=1 << q))
    run_end = np.unpackbits(take(-(-n // 8)), count=n)
    run = np.cumsum(run_end, dtype=np.int64) - run_end
    first = _numbers(take(n * -(-rest // 8)), n, rest) | quotients[run].astype(np.uint64) << U64(rest)
    limbs = [first | U64(bucket << (widths[0] - skipped))]
    limbs += [_numbers(take(n * -(-w // 8)), n, w) for w in widths[1:]]
    counts = take(n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<i8", large, at)
    return limbs, counts


def _pack_ids(ids: np.ndarray) -> bytes:
    """Ids of uint32, lowest bytes of all first: the high bytes are mostly zero and compress away."""
    return ids.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack_ids(data: pa.Scalar) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data.as_buffer(), np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _without_repeated_zeros(ids: np.ndarray) -> np.ndarray:
    keep = ids > 0
    keep[1:] |= ids[:-1] > 0
    return ids[keep]


def _blocks(docs: DataFrame) -> DataFrame:
    """(block, lang, n_words, words, counts, ids): a block of texts of a language, its different words and their counts.

    ids has the words in order, numbered from 1 within the block, and 0 wherever a piece ends.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream, step=TEXT_STEP):
            w = Words(batch.column("text"), parting=_PARTING)
            if not len(w.first):
                continue
            coded = w.coded()
            word = coded.indices.to_numpy()
            piece = np.cumsum(_PIECE[w.data], dtype=np.int64)[w.first]
            row = w.row_of()
            langs = batch.column("lang").dictionary_encode()
            lang_of = langs.indices.to_numpy()[row]
            starts = np.ones(len(row), bool)
            starts[1:] = (row[1:] != row[:-1]) | (piece[1:] != piece[:-1])
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                mine = np.flatnonzero(lang_of == k)
                if not len(mine):
                    continue
                kinds, back, counts = np.unique(word[mine], return_inverse=True, return_counts=True)
                opens = starts[mine]
                ids = np.zeros(len(mine) + np.count_nonzero(opens), np.uint32)
                ids[np.arange(len(mine)) + np.cumsum(opens)] = back + 1
                out = [[lang], [len(mine)], [coded.dictionary.take(pa.array(kinds))], [counts], [_pack_ids(ids)]]
                kind = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary()]
                yield pa.record_batch([pa.array(x, t) for x, t in zip(out, kind, strict=True)], names=["lang", "n_words", "words", "counts", "ids"])

    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    schema = "lang string, n_words bigint, words array<string>, counts array<bigint>, ids binary"
    return cut(texts.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id()), "word-blocks")


def _numbered(blocks: DataFrame, least: int) -> DataFrame:
    """(lang, word, f, id, block, place, first) of the words of blocks that occur `least` times or more in their lang.

    f is that number, id is a number over 0 that no other word of a lang has, place counts the words of a block from 0; first
    marks one row of each word. Words are dealt once, by groups of their hashes, in which they are summed and numbered from 1;
    every NUMBERING-th id is that of a group, so ids are nearly dense and no group has to know the size of others.
    """
    each = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w"))
    each = each.select("block", "lang", "place", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    dealt = each.withColumn("grp", F.pmod(F.xxhash64("word"), F.lit(NUMBERING))).repartition("lang", "grp")
    of = Window.partitionBy("lang", "grp", "word")
    often = dealt.withColumn("f", F.sum("n").over(of)).where(F.col("f") >= least)
    often = often.withColumn("first", F.row_number().over(of.orderBy("block")) == 1)
    own = F.dense_rank().over(Window.partitionBy("lang", "grp").orderBy("word"))
    often = often.withColumn("id", own.cast("bigint") * NUMBERING + F.col("grp"))
    return cut(often.select("lang", "word", "f", "id", "block", "place", "first"), "frequent-words")


def _coded(blocks: DataFrame, numbered: DataFrame) -> DataFrame:
    """(lang, ids) of the blocks: ids of frequent words as in `numbered`, 0 for other words and ends of pieces.

    Each block meets the ids of its own words, so no task needs those of all.
    """
    both = F.shiftleft(F.col("place").cast("bigint"), 32).bitwiseOR(F.col("id"))
    known = numbered.groupBy("block").agg(F.collect_list(both).alias("known"))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for k in range(batch.num_rows):
                known, ids = batch.column("known")[k].values.to_numpy(), _unpack_ids(batch.column("ids")[k])
                id_of = np.zeros(int(ids.max()) + 1, np.uint32)
                id_of[(known >> 32) + 1] = known & 0xFFFFFFFF
                out = _without_repeated_zeros(id_of[ids])
                yield pa.record_batch([batch.column("lang").slice(k, 1), pa.array([_pack_ids(out)], pa.binary())], names=["lang", "ids"])

    joined = blocks.select("block", "lang", "ids").join(known, "block").select("lang", "ids", "known")
    return cut(joined.mapInArrow(run, "lang string, ids binary"), "coded-blocks")


def _pair_place(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Place of a pair of ids in the map of frequent pairs."""
    return (mix(first.astype(np.uint64) << U64(32) | second.astype(np.uint64)) & U64(BITS - 1)).astype(np.int64)


def _pair_map(pairs: DataFrame) -> np.ndarray:
    """Bits that tell which pairs may be frequent, of a fixed size; a bit that is 0 rules out all pairs of its place."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            ids = batch.column("ids").flatten().to_numpy()
            yield pa.record_batch([pa.array(_pair_place(ids[::2], ids[1::2]))], names=["place"])

    return bitmap(pairs.select("ids").mapInArrow(run, "place bigint"))


def _count(coded: DataFrame, lengths: tuple[int, ...], bits: int, skipped: dict[int, int], least: int, pair_map: np.ndarray | None = None) -> DataFrame:
    """(lang, ids, f) of all n-grams of `lengths` words that occur at least `least` times.

    `skipped` has the bits of the bucket number of each length. With a `pair_map` only n-grams are counted whose pairs of
    neighbouring words may all be frequent; no others can be.
    """
    grams = {n: Grams(n, bits) for n in lengths}

    def shard(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list] = {}

        def close(lang: str, n: int) -> Iterator[pa.RecordBatch]:
            parts = held.pop((lang, n))
            limbs, counts = counted([np.concatenate([p[k] for p in parts]) for k in range(len(parts[0]))])
            widths, s = grams[n].widths, skipped[n]
            bucket = (limbs[0] >> U64(widths[0] - s)).astype(np.int64)
            at = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]]).tolist()
            for a, z in zip(at[:-1], at[1:], strict=True):
                data = build_filter([x[a:z] for x in limbs], counts[a:z], widths, s)
                row = [pa.array([lang]), pa.array([n], pa.int32()), pa.array([int(bucket[a])]), pa.array([data], pa.binary())]
                yield pa.record_batch(row, names=["lang", "n", "bucket", "data"])

        for batch in stream:
            for r in range(batch.num_rows):
                lang, ids = batch.column("lang")[r].as_py(), _unpack_ids(batch.column("ids")[r]).astype(np.uint64)
                follows = (ids[:-1] > 0) & (ids[1:] > 0)
                if pair_map is not None:
                    follows &= marked(pair_map, _pair_place(ids[:-1], ids[1:]))
                run = follows
                for n in range(2, max(lengths) + 1):
                    if n > 2:
                        run = run[:-1] & follows[n - 2 :]
                    if n in grams and len(at := np.flatnonzero(run)):
                        held.setdefault((lang, n), []).append(grams[n].permuted([ids[at + k] for k in range(n)]))
                while sum(sizes := [sum(len(p) * len(p[0]) for p in parts) for parts in held.values()]) >= HELD:
                    yield from close(*list(held)[int(np.argmax(sizes))])
        for lang, n in list(held):
            yield from close(lang, n)

    def merge(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts = None, []

        def close() -> pa.RecordBatch:
            lang, n, _ = key
            limbs, counts = counted([np.concatenate([p[0][k] for p in parts]) for k in range(len(parts[0][0]))], np.concatenate([p[1] for p in parts]))
            often = np.flatnonzero(counts >= least)
            ids = np.stack(grams[n].restored([x[often] for x in limbs]), 1).astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, ids.size + 1, n), pa.int32()), pa.array(ids.ravel()))
            return pa.record_batch([pa.array([lang] * len(often), pa.string()), lists, pa.array(counts[often])], names=["lang", "ids", "f"])

        for batch in stream:
            for r in range(batch.num_rows):
                now = tuple(batch.column(c)[r].as_py() for c in ("lang", "n", "bucket"))
                if now != key and parts:
                    yield close()
                    parts = []
                key = now
                parts.append(filter_entries(batch.column("data")[r].as_py(), grams[now[1]].widths, skipped[now[1]], now[2]))
        if parts:
            yield close()

    filters = coded.mapInArrow(shard, "lang string, n int, bucket bigint, data binary")
    dealt = filters.repartition("lang", "n", "bucket").sortWithinPartitions("lang", "n", "bucket")
    return dealt.mapInArrow(merge, "lang string, ids array<bigint>, f bigint")


def frequent_phrases(docs: DataFrame, least: int, longest: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(phrases, words, totals) of `docs` (text, lang).

    phrases: (lang, ids, f) of all sequences of 1 to `longest` words within pieces that occur at least `least` times in a
    language; words: (lang, word, f, id) of the words among them; totals: (lang, n), the number of word occurrences.
    """
    blocks = _blocks(docs)
    numbered = _numbered(blocks, least)
    words = cut(numbered.where("first").select("lang", "word", "f", "id"), "words")
    totals = blocks.groupBy("lang").agg(F.sum("n_words").alias("n"))
    size = words.agg(F.max("id").alias("ids"), F.sum("f").alias("n")).first()
    bits, instances = max(1, int(size.ids or 0).bit_length()), int(size.n or 0)
    coded = _coded(blocks, numbered.select("block", "place", "id"))
    skipped = {n: min(max(0, (instances // MERGED).bit_length()), 2 * bits) for n in range(2, longest + 1)}
    single = words.select("lang", F.array("id").alias("ids"), "f")
    pairs = cut(_count(coded, (2,), bits, skipped, least), "pairs")
    found = single.unionByName(pairs)
    if longest > 2:
        found = found.unionByName(_count(coded, tuple(range(3, longest + 1)), bits, skipped, least, _pair_map(pairs)))
    return cut(found, "phrases"), words, totals


def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(17,0)")


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, share: int = 100, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases of each language.

    A-Z are lowered; `.,;:!?` and line ends cut texts into pieces, spaces and tabs cut these into words. A phrase is two to
    `longest` words that follow each other in a piece a >= `least` times. Each way to cut it after its first words gives a
    score floor(1000 a n / (l r)), l and r being the counts of the two parts and n that of all words; the lowest counts, the
    earliest cut of equal ones. A phrase within a longer one that is at least `share` hundredths as frequent is left out.
    Phrases are ranked by score, then a, then UTF-8 bytes. A NULL lang is `und`. NULL and empty texts have no words; an
    empty table gives no rows. Rows count each, repeated or not; other columns are not looked at.
    """
    phrases, words, totals = frequent_phrases(docs, least, longest)
    several = phrases.where("size(ids) > 1").withColumnRenamed("f", "a")
    parts = phrases.withColumnRenamed("ids", "part")
    cuts = several.select("lang", "ids", "a", F.explode(F.expr("sequence(1, size(ids) - 1)")).alias("k"))
    cuts = cuts.withColumn("left", F.expr("slice(ids, 1, k)")).withColumn("right", F.expr("slice(ids, k + 1, size(ids) - k)"))
    cuts = cuts.join(parts.withColumnsRenamed({"part": "left", "f": "l"}), ["lang", "left"])
    cuts = cuts.join(parts.withColumnsRenamed({"part": "right", "f": "r"}), ["lang", "right"])
    # One row for each language.
    cuts = cuts.join(totals, "lang").withColumns({c: _exact(c) for c in ("a", "l", "r", "n")})
    scored = cuts.withColumn("score", F.expr("cast(a * n * 1000 div (l * r) as bigint)"))
    best = scored.groupBy("lang", "ids").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("best")).select("lang", "ids", "best.*")
    inner = "flatten(transform(sequence(2, size(ids) - 1), m -> transform(sequence(1, size(ids) - m + 1), s -> slice(ids, s, m))))"
    within = several.where("size(ids) > 2").select("lang", F.explode(F.expr(inner)).alias("ids"), F.col("a").alias("longer"))
    within = within.groupBy("lang", "ids").agg(F.max("longer").alias("longer"))
    kept = best.join(within, ["lang", "ids"], "left").where(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True)))
    placed = kept.select("lang", "ids", F.posexplode("ids").alias("place", "id")).join(words.select("lang", "id", "word"), ["lang", "id"])
    spelled = placed.groupBy("lang", "ids").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("w"))
    named = kept.join(spelled.select("lang", "ids", F.array_join("w.word", " ").alias("phrase")), ["lang", "ids"])
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint"), "phrase", *[F.col(c).cast("bigint") for c in ("a", "l", "r", "n", "score")])
