"""SimHash near duplicates: exact comparison of fingerprints tile by tile.

Distinct fingerprints are put into tiles, tiles into blocks of bounded size, and a task compares one pair of blocks with
exclusive-or and bit counts. A pair of tiles is skipped if population counts rule out every link: each part of a
fingerprint differs in at least as many bits as its population counts differ, so the differences of all parts are
summed. A block pair returns a spanning forest of its links, never all pairs within a group.

Similar texts whose fingerprints differ by more bits are found by their shingles: two sets of a Jaccard similarity of t share
one of the n - ceil(t n) + 1 shingles that come first in an order of all shingles, rare ones first.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.components import components
from tickloom.llm.kneser_ney import KEYS, _bucket, _pack, _unpack
from tickloom.llm.words import U64, Words, batches, mix, sums
from tickloom.session import cut

BLOCK = 4096  # fingerprints of a block
SHINGLES = 1 << 17  # shingles of a block that carries them, about, or one document
SLICE = 32  # rows of a block compared at once with all of the other
#: 16-bit lanes of a fingerprint word whose population counts make a tile
LANES = 4
RARITY = 20  # bits of a shingle's hash by which occurrences are added up, to put rare shingles first
ENTRIES = 1 << 20  # first shingles of a bucket, about, and those of a task that are dealt out together
PAIRS = 1 << 21  # pairs of sets with a common first shingle that are looked at together

# All eight bits of a byte as eight lanes of a 64-bit number, highest bit first in memory.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()


def _xxh_shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 (seed 42) of each shingle of space-joined words, and the shingle offsets of the rows."""
    text, first, end, rows = w.data.tobytes(), w.first.tolist(), w.end.tolist(), w.rows.tolist()
    digest, out, offsets = xxhash.xxh64_intdigest, [], [0]
    for a, z in itertools.pairwise(rows):
        words = [text[i:j] for i, j in zip(first[a:z], end[a:z], strict=True)]
        if z - a > size:
            joined = b" ".join(words)
            stop = list(itertools.accumulate(len(x) + 1 for x in words))
            start = [0, *stop]
            out += [digest(joined[i : j - 1], 42) for i, j in zip(start, stop[size - 1 :], strict=False)]
        elif words:
            out.append(digest(b" ".join(words), 42))
        offsets.append(len(out))
    return np.array(out, np.uint64), np.array(offsets)


def _mixed_shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each shingle made of the words' hashes, and the shingle offsets of the rows."""
    h, counts = w.hashes(), np.diff(w.rows)
    n = np.where(counts > size, counts - size + 1, np.minimum(counts, 1))
    offsets = np.concatenate([[0], np.cumsum(n)])
    start = np.repeat(w.rows[:-1], n) + np.arange(offsets[-1]) - np.repeat(offsets[:-1], n)
    length = np.repeat(np.minimum(counts, size), n)
    out = np.zeros(len(start), np.uint64)
    for k in range(size):
        there = k < length
        out[there] = (out[there] + h[start[there] + k]) * U64(0xD6E8FEB86659FD93)
    return mix(out), offsets


def _distinct(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different hashes of each row in order, and their offsets."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    return hashes[first], np.searchsorted(row[first], np.arange(len(offsets)))


def _majority(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each row a 64-bit number whose bits are set in over half the row's hashes; 0 for none."""
    n = np.diff(offsets)
    out = np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    # Lanes of one byte hold 255 at most: rows are summed in runs of up to 255 hashes.
    runs = -(-n[full] // 255)
    first = np.concatenate([[0], np.cumsum(runs)])
    starts = np.repeat(offsets[:-1][full], runs) + 255 * (np.arange(first[-1]) - np.repeat(first[:-1], runs))
    # Arrange each hash from its highest byte to its lowest.
    lanes = _SPREAD[hashes.byteswap().view(np.uint8).reshape(-1, 8)]
    counts = np.add.reduceat(lanes, starts, axis=0).view(np.uint8).reshape(-1, 64)
    bits = np.add.reduceat(counts, first[:-1], axis=0, dtype=np.int64) * 2 > n[full][:, None]
    out[full] = np.packbits(bits, axis=1).view(np.uint64).ravel().byteswap()
    return out


def fingerprints(docs: DataFrame, shingle: int = 3, words: int = 1, exact: bool = True, distinct: bool = False) -> DataFrame:
    """(doc_id, text_hash, n, f0, f1, ...): SimHash of each row's text, 64 bits for each of `words` columns.

    A-Z are lowered, words split at white space, `shingle` words make a shingle, repeats count; a text of fewer words is
    one shingle, a NULL or empty one has fingerprint 0. With `exact` a shingle's hash is the XXH64 of its UTF-8 text, else
    it is made from the hashes of its words, which is cheaper; further 64-bit words are remixed from the first. n is the
    number of shingles, text_hash tells rows of one doc_id apart. With `distinct` a repeated shingle counts once, and a
    further column set_hash is equal for rows with the same shingles.
    """
    names = [f"f{k}" for k in range(words)]
    salts = [U64(k * 0x9E3779B97F4A7C15 % 2**64) for k in range(words)]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream):
            h, offsets = (_xxh_shingles if exact else _mixed_shingles)(Words(batch.column("text")), shingle)
            if distinct:
                h, offsets = _distinct(h, offsets)
            out = [sums(mix(h + U64(1)), offsets)] if distinct else []
            out += [_majority(mix(h + salt) if salt else h, offsets) for salt in salts]
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(np.diff(offsets)), *(pa.array(x.view(np.int64)) for x in out)]
            yield pa.record_batch(columns, names=["doc_id", "text_hash", "n", *more, *names])

    more = ["set_hash"] if distinct else []
    schema = ", ".join(f"{c} bigint" for c in ("doc_id", "text_hash", "n", *more, *names))
    return docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, schema)


def _compare(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, radius: int, ratio: float, same: bool) -> np.ndarray:
    """Links (i, j) between the rows of `a` and `b`, both of shape (n, words), that keep all components."""
    parent = np.arange(len(a) + len(b))
    columns = [np.ascontiguousarray(b[:, k]) for k in range(b.shape[1])]
    out = []
    for at in range(0, len(a), SLICE):
        part = a[at : at + SLICE]
        bits = np.bitwise_count(part[:, 0][:, None] ^ columns[0])
        for k in range(1, len(columns)):
            bits = np.add(bits, np.bitwise_count(part[:, k][:, None] ^ columns[k]), dtype=np.uint16)
        i, j = np.nonzero(bits <= radius)
        i += at
        near = np.minimum(size_a[i], size_b[j]) >= ratio * np.maximum(size_a[i], size_b[j])
        if same:
            near &= i < j
        i, j = i[near], j[near]
        while len(i):
            # Of the links between groups not yet joined, each group takes the one to its smallest neighbour.
            x, y = parent[i], parent[j if same else j + len(a)]
            open_ = x != y
            i, j, x, y = i[open_], j[open_], x[open_], y[open_]
            if not len(i):
                break
            high, low = np.maximum(x, y), np.minimum(x, y)
            order = np.lexsort((low, high))
            first = order[np.concatenate([[True], high[order][1:] != high[order][:-1]])]
            out.append(np.stack([i[first], j[first]], 1))
            parent[high[first]] = low[first]
            while not np.array_equal(up := parent[parent], parent):
                parent = up
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def _steps(radius: int) -> list[int]:
    """Differences of tile numbers within reach, each unordered pair once: tiles are base-32 numbers of lane counts."""
    one = range(-min(radius, 16), min(radius, 16) + 1)
    found = [d for d in itertools.product(one, repeat=LANES) if sum(map(abs, d)) <= radius]
    return sorted(d for d in {sum(x * 32**k for k, x in enumerate(d)) for d in found} if d >= 0)


def near_links(prints: DataFrame, radius: int, ratio: float = 0.0) -> DataFrame:
    """(a, b) links between the keys of a table (key, n, f0, f1, ...) of distinct fingerprints at `radius` or fewer bits.

    Enough links to keep every component, at most one for each fingerprint and block pair. With a `ratio`, sizes n of
    linked rows differ by no more than that ratio (a Jaccard similarity never exceeds it), and tiles are classes of n;
    without, tiles are the population counts of the four 16-bit lanes, and small radii compare a few hundredths of all
    pairs. The work still grows with the square of the fingerprints, as exact comparison does.
    """
    names = [c for c in prints.columns if c not in ("key", "n")]
    if ratio:
        tile = F.when(F.col("n") > 0, F.floor(F.log("n") / -np.log(ratio) + 1e-9)).otherwise(-9).cast("bigint")
        steps = [0, 1]
    else:
        counts = [F.bit_count(F.shiftrightunsigned(names[0], 16 * k).bitwiseAND(F.lit(0xFFFF))).cast("bigint") * 32**k for k in range(LANES)]
        tile = sum(counts[1:], counts[0])
        steps = _steps(radius)
    columns = ("key", "n", *names)
    tiled = prints.select(*columns, tile.alias("tile"))
    sizes = tiled.groupBy("tile").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    blocks = (
        tiled.join(sizes, "tile")
        .groupBy("tile", F.pmod(F.xxhash64("key", F.lit(1)), "blocks").alias("block"))
        .agg(F.collect_list(F.struct(*columns)).alias("rows"))
        .select("tile", "block", *[F.col(f"rows.{c}").alias(c) for c in columns])
    )
    blocks = cut(blocks, "blocks")
    left = blocks.select(*[F.col(c).alias(f"l_{c}") for c in blocks.columns], F.explode(F.array(*[F.lit(r) for r in steps])).alias("step"))
    pairs = (
        left.withColumn("tile", F.col("l_tile") + F.col("step"))
        .join(blocks, "tile")
        .where("step > 0 or l_block <= block")
        .withColumn("same", F.expr("step = 0 and l_block = block"))
        .drop("tile", "l_tile", "step", "block", "l_block")
    )

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for r in range(batch.num_rows):
                value = {c: batch.column(c)[r].values.to_numpy() for c in batch.schema.names if c != "same"}
                a, b = (np.stack([value[p + n].view(np.uint64) for n in names], 1) for p in ("l_", ""))
                links = _compare(a, b, value["l_n"], value["n"], radius, ratio, batch.column("same")[r].as_py())
                yield pa.record_batch([pa.array(value["l_key"][links[:, 0]]), pa.array(value["key"][links[:, 1]])], names=["a", "b"])

    return pairs.mapInArrow(run, "a bigint, b bigint")


def _shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(key, shingles): the different shingles of each row's text, in order."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream):
            h, offsets = _distinct(*_mixed_shingles(Words(batch.column("text")), shingle))
            yield pa.record_batch([batch.column("key"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(h.view(np.int64)))], names=["key", "shingles"])

    return docs.select("key", "text").mapInArrow(run, "key bigint, shingles array<bigint>")


def _verified_pairs(a: dict, b: dict, radius: int, similarity: float, same: bool) -> list[tuple[int, int]]:
    """Keys of verified links between the rows of two blocks, enough to keep all components."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = up = parent.get(up, up)
            x = up
        return x

    out = []
    for i in range(len(a["key"])):
        bits = np.bitwise_count(a["prints"][i] ^ b["prints"]).sum(1)
        near = (bits <= radius) & (np.minimum(a["n"][i], b["n"]) >= similarity * np.maximum(a["n"][i], b["n"])) & (a["joined"][i] != b["joined"])
        if same:
            near[: i + 1] = False
        for j in np.flatnonzero(near).tolist():
            x, y = root(int(a["joined"][i])), root(int(b["joined"][j]))
            if x != y:
                common = len(np.intersect1d(a["shingles"][i], b["shingles"][j], assume_unique=True))
                if common >= similarity * (a["n"][i] + b["n"][j] - common) - 1e-9:
                    parent[max(x, y)] = min(x, y)
                    out.append((int(a["key"][i]), int(b["key"][j])))
    return out


def _compare_groups(members: DataFrame, radius: int, similarity: float) -> DataFrame:
    """(a, b) verified links within each group of (key, n, f0, f1, ..., grp, joined, shingles), between rows not yet `joined`.

    Every pair of a group at `radius` or fewer bits is verified before it can enter the spanning forest of its block pair.
    """
    names = [c for c in members.columns if c[0] == "f"]
    columns = ("key", "n", *names, "joined", "shingles")
    tiled = members.select(*columns, "grp", F.floor(F.log("n") / -np.log(similarity) + 1e-9).cast("bigint").alias("tile"))
    sizes = tiled.groupBy("grp", "tile").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / SHINGLES)).alias("blocks"))
    blocks = (
        tiled.join(sizes, ["grp", "tile"])
        .groupBy("grp", "tile", F.pmod(F.xxhash64("key", F.lit(1)), "blocks").alias("block"))
        .agg(F.collect_list(F.struct(*columns)).alias("rows"))
    )
    blocks = cut(blocks, "group-blocks")
    left = blocks.select("grp", F.col("tile").alias("l_tile"), F.col("block").alias("l_block"), F.col("rows").alias("l_rows"), F.explode(F.array(F.lit(0), F.lit(1))).alias("step"))
    pairs = left.withColumn("tile", F.col("l_tile") + F.col("step")).join(blocks, ["grp", "tile"]).where("step > 0 or l_block <= block")
    pairs = pairs.select("l_rows", "rows", F.expr("step = 0 and l_block = block").alias("same"))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for r in range(batch.num_rows):
                sides = []
                for c in ("l_rows", "rows"):
                    rows = batch.column(c)[r].values
                    value = {x: rows.field(x).to_numpy() for x in ("key", "n", "joined")}
                    value["prints"] = np.stack([rows.field(x).to_numpy().view(np.uint64) for x in names], 1)
                    value["shingles"] = [x.values.to_numpy() for x in rows.field("shingles")]
                    sides.append(value)
                links = np.array(_verified_pairs(*sides, radius, similarity, batch.column("same")[r].as_py()), np.int64).reshape(-1, 2)
                yield pa.record_batch([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])

    return pairs.mapInArrow(run, "a bigint, b bigint")


def _sets_of(docs: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """(key, shingles) of nodes, from the text of the `row` of each."""
    chosen = nodes.select("key", F.col("row.doc_id").alias("_doc_id"), F.col("row.text_hash").alias("_text_hash"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("_doc_id"), F.xxhash64("text").alias("_text_hash"), "text")
    texts = texts.join(chosen, ["_doc_id", "_text_hash"]).dropDuplicates(["_doc_id", "_text_hash"])
    return cut(_shingle_sets(texts, shingle), "shingles")


def _judged(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b, holds): whether the shingles of the keys a and b are as similar."""
    met = pairs.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    met = met.select("a", "b", F.size("x").alias("m"), F.size("y").alias("n"), common.alias("common"))
    return cut(met.select("a", "b", (F.col("common") >= similarity * (F.col("m") + F.col("n") - F.col("common")) - 1e-9).alias("holds")), "judged")


def verified_links(docs: DataFrame, nodes: DataFrame, links: DataFrame, radius: int, shingle: int, similarity: float) -> DataFrame:
    """(a, b) links of texts whose shingles have a Jaccard similarity of `similarity` or more, enough to keep every component.

    `links` is a spanning forest of the pairs of `nodes` (key, n, f0, ..., row: one row's doc_id and text_hash) at `radius` or
    fewer bits. Where all links of a group hold, the forest stands; in the other groups each such pair is verified.
    """
    links = cut(links, "candidates")
    ends = links.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    linked = cut(nodes.join(ends, "key"), "linked")
    sets = _sets_of(docs, linked, shingle)
    judged = _judged(links, sets, similarity)
    holding = judged.where("holds").select("a", "b")
    if judged.where("not holds").isEmpty():
        return holding
    groups = cut(components(links), "groups")
    doubtful = groups.join(judged.where("not holds").select(F.col("a").alias("node")).distinct(), "node").select("root").distinct()
    members = groups.join(doubtful, "root").select(F.col("node").alias("key"), F.col("root").alias("grp"))
    joined = components(holding).select(F.col("node").alias("key"), F.col("root").alias("joined"))
    members = linked.drop("row").join(members, "key").join(joined, "key", "left").withColumn("joined", F.coalesce("joined", "key")).join(sets, "key")
    return holding.unionByName(_compare_groups(members, radius, similarity))


def _rarity(docs: DataFrame, shingle: int) -> np.ndarray:
    """How often shingles occur, by the first bits of their hashes, on a logarithmic scale.

    It puts shingles in order and rules nothing out: those that share bits with frequent ones only cost time.
    """

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << RARITY, np.int64)
        for batch in batches(stream):
            h, _ = _distinct(*_mixed_shingles(Words(batch.column("text")), shingle))
            total += np.bincount((h >> U64(64 - RARITY)).astype(np.int64), minlength=len(total))
        parts = total.reshape(64, -1)
        yield pa.record_batch([pa.array(np.arange(64)), pa.array([_pack(x, np.int64) for x in parts], pa.binary())], names=["part", "counts"])

    def add(parts: pa.Table) -> pa.Table:
        total = sum(_unpack(x.as_py(), np.int64) for x in parts.column("counts"))
        level = np.minimum(8 * np.log2(total + 1), 255).astype(np.uint8)
        return pa.table([parts.column("part").slice(0, 1), pa.array([level.tobytes()], pa.binary())], names=["part", "level"])

    rows = docs.select("text").mapInArrow(count, "part bigint, counts binary").groupBy("part").applyInArrow(add, "part bigint, level binary").collect()  # 1 MB
    found = {r.part: np.frombuffer(r.level, np.uint8) for r in rows}
    none = np.zeros((1 << RARITY) // 64, np.uint8)
    return np.concatenate([found.get(k, none) for k in range(64)])


_COLUMNS = {"h": KEYS, "set_hash": np.uint64, "n": np.uint32, "place": np.uint32}


def _first_shingles(docs: DataFrame, shingle: int, similarity: float, level: np.ndarray, buckets: int) -> DataFrame:
    """(bucket, h, set_hash, n, place) of the first n - ceil(similarity n) + 1 shingles of each set, rare ones first, of those that several sets have among theirs."""
    names = list(_COLUMNS)

    def dealt(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        h, *rest = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(h)
        columns = [h[order], *(x[order] for x in rest)]
        ends = np.searchsorted(_bucket(columns[0], buckets), np.arange(buckets), "right").tolist()
        parts = [(b, slice(at, end)) for b, (at, end) in enumerate(zip([0, *ends], ends)) if at < end]
        packed = [pa.array([_pack(x[i], kind) for _, i in parts], pa.binary()) for x, kind in zip(columns, _COLUMNS.values(), strict=True)]
        return pa.record_batch([pa.array([b for b, _ in parts], pa.int64()), *packed], names=["bucket", *names])

    def first(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches(stream):
            h, offsets = _distinct(*_mixed_shingles(Words(batch.column("text")), shingle))
            n, set_hash = np.diff(offsets), sums(mix(h + U64(1)), offsets)
            row = np.repeat(np.arange(len(n)), n)
            h = h[np.lexsort((h, level[(h >> U64(64 - RARITY)).astype(np.int64)], row))]
            place = np.arange(len(h)) - offsets[row]
            prefix = n - np.ceil(n * similarity - 1e-9).astype(np.int64) + 1
            prefix[np.setdiff1d(np.arange(len(n)), np.unique(set_hash, return_index=True)[1])] = 0  # equal sets once
            here = place < prefix[row]
            held.append([h[here], set_hash[row[here]], n[row[here]], place[here]])
            size += np.count_nonzero(here)
            if size > ENTRIES:
                yield dealt(held)
                held, size = [], 0
        if held:
            yield dealt(held)

    def meet(pieces: pa.Table) -> pa.Table:
        h, set_hash, n, place = (np.concatenate([_unpack(x.as_py(), kind) for x in pieces.column(c)]) for c, kind in _COLUMNS.items())
        order = np.lexsort((set_hash, h))
        h, set_hash = h[order], set_hash[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (set_hash[1:] != set_hash[:-1])
        h, set_hash, order = h[new], set_hash[new], order[new]
        same = np.zeros(len(h) + 1, bool)
        same[1:-1] = h[1:] == h[:-1]
        several = same[1:] | same[:-1]
        out = [h[several].view(np.int64), set_hash[several].view(np.int64), n[order[several]].astype(np.int64), place[order[several]].astype(np.int64)]
        bucket = pa.array(np.full(len(out[0]), pieces.column("bucket")[0].as_py()), pa.int64())
        return pa.table([bucket, *(pa.array(x) for x in out)], names=["bucket", *names])

    pieces = docs.select("text").mapInArrow(first, "bucket bigint, " + ", ".join(f"{c} binary" for c in names))
    return pieces.groupBy("bucket").applyInArrow(meet, "bucket bigint, " + ", ".join(f"{c} bigint" for c in names))


def links_by_shingles(docs: DataFrame, nodes: DataFrame, links: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(a, b) of all pairs of `nodes` in different components of `links` whose shingles have a Jaccard similarity of `similarity` or more.

    Pairs are looked at if they share one of their first shingles; sizes and places of their first common one rule pairs out.
    """
    buckets = min((nodes.agg(F.sum("n")).first()[0] or 0) // (5 * ENTRIES) + 1, 1 << 16)
    firsts = _first_shingles(docs, shingle, similarity, _rarity(docs, shingle), buckets)
    roots = components(links).select(F.col("node").alias("key"), "root")
    sets = nodes.select("set_hash", "n", "key").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))

    def pair(rows: pa.Table) -> pa.Table:
        h, key, root, n, place = (rows.column(c).to_numpy() for c in ("h", "key", "root", "n", "place"))
        order = np.lexsort((root, h))
        h, key, root, n, place = (x[order] for x in (h, key, root, n, place))
        # Rows of a shingle meet those behind the rows of their own component.
        ends = np.flatnonzero(np.append((h[1:] != h[:-1]) | (root[1:] != root[:-1]), True)) + 1
        behind = ends[np.searchsorted(ends, np.arange(len(h)), "right")]
        times = np.searchsorted(h, h, "right") - behind
        upto, out, at = np.cumsum(times), np.zeros((0, 2), np.int64), 0
        while at < len(h):
            to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, "right")))
            many = times[at:to]
            i = np.repeat(np.arange(at, to), many)
            j = np.repeat(behind[at:to] - np.cumsum(many) + many, many) + np.arange(len(i))
            near = np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]) - 1e-9
            near &= np.minimum(n[i] - place[i], n[j] - place[j]) >= similarity / (1 + similarity) * (n[i] + n[j]) - 1e-9
            found = np.stack([np.minimum(key[i[near]], key[j[near]]), np.maximum(key[i[near]], key[j[near]])], 1)
            out, at = np.unique(np.concatenate([out, found]), axis=0), to
        return pa.table([pa.array(out[:, 0]), pa.array(out[:, 1])], names=["a", "b"])

    met = firsts.join(sets, ["set_hash", "n"]).select("bucket", "h", "key", "root", "n", "place")
    pairs = cut(met.groupBy("bucket").applyInArrow(pair, "a bigint, b bigint").distinct(), "pairs", free=True)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    judged = _judged(pairs, _sets_of(docs, nodes.join(ends, "key"), shingle), similarity)
    return judged.where("holds").select("a", "b")


def near_components(prints: DataFrame, radius: int, ratio: float = 0.0, verify: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> DataFrame:
    """The table of fingerprints() with component_id, the smallest doc_id reachable over links of `radius` or fewer bits.

    Equal fingerprints are one node (with a `ratio`, of equal size n; rows with a set_hash, of equal shingles). Rows with a
    NULL doc_id link like others; a component of such rows only has component_id NULL. An empty table gives no rows.
    `verify` makes of the nodes and their links those that count.
    """
    prints = cut(prints, "fingerprints")
    names = [c for c in prints.columns if c.startswith("f")]
    node = [*names, *(["n"] if ratio else []), *(["set_hash"] if "set_hash" in prints.columns else [])]
    key = F.xxhash64(*node) if len(node) > 1 else F.col("f0")
    row = [F.min(F.struct("doc_id", "text_hash")).alias("row")] if verify else []
    nodes = prints.groupBy(*node).agg(F.min("doc_id").alias("least"), *row, *([] if ratio else [F.lit(0).cast("bigint").alias("n")])).withColumn("key", key)
    nodes = cut(nodes, "nodes")
    links = near_links(nodes.select("key", "n", *names), radius, ratio)
    roots = components(verify(nodes.drop("least"), links) if verify else links)
    rooted = nodes.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.join(least, "root").select(*node, "component_id"), node).select(*prints.columns, "component_id")


def one_of_each(docs: DataFrame, shingle: int = 5, words: int = 4, similarity: float = 0.8) -> DataFrame:
    """The rows of `docs`, all columns, with one document kept of each group of near duplicates.

    Documents link if the Jaccard similarity of their sets of shingles is at least `similarity`, all of them. Most links are
    found among the pairs with as many equal fingerprint bits, the rest by common rare shingles. The smallest doc_id of a
    group stays; rows of one doc_id are one document: the row with the smallest text hash. NULL and empty texts are one
    group. Rows with a NULL doc_id cannot be named and all stay.
    """
    radius = int(64 * words * (1 - similarity) + 1e-9)
    known = docs.where("doc_id is not null")
    prints = fingerprints(known, shingle, words, exact=False, distinct=True)

    def verify(nodes: DataFrame, links: DataFrame) -> DataFrame:
        alike = cut(verified_links(known, nodes, links, radius, shingle, similarity), "verified")
        return alike.unionByName(links_by_shingles(known, nodes, alike, shingle, similarity))

    found = near_components(prints, radius, similarity, verify)
    keep = found.where("doc_id = component_id").groupBy("doc_id").agg(F.min("text_hash").alias("text_hash"))
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    keyed = known.select(own, F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"))
    kept = keyed.join(keep, ["doc_id", "text_hash"], "left_semi").dropDuplicates(["doc_id", "text_hash"])
    return kept.select("doc.*").unionByName(docs.where("doc_id is null"))
