"""MinHash near duplicates by an LSH forest: signatures sorted in several orders, neighbours in each order compared.

A signature has a byte for each of 64 hash functions. An order puts these bytes into a sequence of its own and sorts the
documents by it, so those that share a long prefix lie next to each other. A document's candidates are the nearest ones that
share `LEAST_DEPTH` bytes with it: in sparse regions all of them, in dense regions only those with the longest common prefix.
Candidates whose signatures agree well enough are confirmed on their full sets of shingles.

Equal sets are one node. The direct neighbours in the first orders join the members of large groups by few links. Documents
that then have candidates in other components go through all orders again, with their sets beside them, and are confirmed
where they meet: a task returns a spanning forest of its links, so the work for a group of near copies grows with its size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.bitmaps import BITS, bitmap, marked
from tickloom.llm.components import components
from tickloom.llm.simhash import _distinct, _mixed_shingles
from tickloom.llm.words import U64, Words, batches, mix, sums
from tickloom.session import cut

SHINGLE = 4  # words
SIMILARITY = 80  # hundredths
HASHES = 64  # bytes of a signature
ORDERS = 16
FIRST_ORDERS = 3  # orders whose direct neighbours are compared before all others
LEAST_DEPTH = 3  # bytes that candidates share at least
REACH = 256  # neighbours of a document that are looked at in a dense region

_ODD = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * U64(0x9E3779B97F4A7C15)) | U64(1)
_ORDER = np.stack([np.random.default_rng(k).permutation(HASHES) for k in range(ORDERS)])


def _least_agreement(similarity: int) -> int:
    """Equal bytes below which signatures are not compared further: four standard deviations under the threshold."""
    p = similarity / 100
    return max(LEAST_DEPTH, math.floor(HASHES * p - 4 * math.sqrt(HASHES * p * (1 - p))))


def signatures(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of HASHES bytes for each set of shingle hashes: of the least value under each hash function. Empty sets have zeros."""
    full = np.flatnonzero(np.diff(offsets))
    out = np.zeros((len(offsets) - 1, HASHES), np.uint8)
    if len(full):
        for k in range(HASHES):
            out[full, k] = (mix(np.minimum.reduceat(hashes * _ODD[k], offsets[full])) >> U64(56)).astype(np.uint8)
    return out


def prints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, n, key, signature) of each row: n different shingles, key equal for equal sets of shingles."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream):
            h, offsets = _distinct(*_mixed_shingles(Words(batch.column("text")), shingle))
            n = np.diff(offsets)
            key = mix(sums(mix(h + U64(1)), offsets) + n.astype(np.uint64)).view(np.int64)
            rows = pa.FixedSizeBinaryArray.from_buffers(pa.binary(HASHES), len(n), [None, pa.py_buffer(signatures(h, offsets))])
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(n), pa.array(key), rows.cast(pa.binary())]
            yield pa.record_batch(columns, names=["doc_id", "text_hash", "n", "key", "signature"])

    schema = "doc_id bigint, text_hash bigint, n bigint, key bigint, signature binary"
    return docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, schema)


COLUMNS = {"order": "int", "signature": "binary", "key": "bigint", "n": "bigint", "root": "bigint"}
SETS = {"shingles": "array<bigint>"}


def _schema(columns: dict[str, str]) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in columns.items())


def _ordered(nodes: DataFrame, orders: int) -> DataFrame:
    """`nodes` (key, n, root, signature and maybe shingles) once for each order, the signature's bytes in that order."""
    own = [c for c in (*COLUMNS, *SETS) if c in nodes.columns and c != "signature"]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            rows = _matrix(batch.column("signature"))
            for k in range(orders):
                turned = np.ascontiguousarray(rows[:, _ORDER[k]])
                signature = pa.FixedSizeBinaryArray.from_buffers(pa.binary(HASHES), len(rows), [None, pa.py_buffer(turned)]).cast(pa.binary())
                order = pa.array(np.full(len(rows), k, np.int32))
                yield pa.record_batch([order, signature, *(batch.column(c) for c in own)], names=["order", "signature", *own])

    schema = {c: t for c, t in (COLUMNS | SETS).items() if c in ("order", "signature", *own)}
    return nodes.select("signature", *own).mapInArrow(run, _schema({c: schema[c] for c in ("order", "signature", *own)}))


def _matrix(column: pa.Array) -> np.ndarray:
    """Signatures as rows of bytes."""
    if not len(column):
        return np.zeros((0, HASHES), np.uint8)
    return np.frombuffer(column.cast(pa.binary(HASHES)).buffers()[1], np.uint8).reshape(-1, HASHES)[: len(column)]


def _here(order: np.ndarray, equal: np.ndarray) -> np.ndarray:
    """Whether pairs with these equal bytes, in their order, have no longer common prefix in another order, or in an earlier one."""
    plain, best = np.empty_like(equal), np.full(len(equal), -1)
    np.put_along_axis(plain, _ORDER[order], equal, axis=1)
    longest = np.full(len(equal), -1)
    for k in range(ORDERS):
        turned = plain[:, _ORDER[k]]
        depth = np.where(turned.all(1), HASHES, np.argmin(turned, axis=1))
        best = np.where(depth > longest, k, best)
        longest = np.maximum(depth, longest)
    return best == order


def _near(v: dict[str, np.ndarray], part: str, reach: int, similarity: int, fresh: int, once: bool) -> np.ndarray:
    """Pairs (i, j), i < j, of sorted rows up to `reach` apart that may be linked; j is no row before `fresh`.

    Rows of one root or of one side of a cut (`side`, where there is one) make no pair. With `once` a pair is found in one
    order only.
    """
    least, open_, rows = _least_agreement(similarity), np.arange(max(0, fresh - reach), len(v["key"])), v["rows"]
    out = [np.zeros((2, 0), np.int64)]
    for k in range(1, reach + 1):
        open_ = open_[open_ + k < len(rows)]
        # What shares no prefix with a row shares none with those before it.
        open_ = open_[(v[part][open_] == v[part][open_ + k]) & (rows[open_, :LEAST_DEPTH] == rows[open_ + k, :LEAST_DEPTH]).all(1)]
        if not len(open_):
            break
        i = open_[(open_ + k >= fresh) & (v["root"][open_] != v["root"][open_ + k])]
        if "side" in v:
            i = i[v["side"][i] != v["side"][i + k]]
        i = i[100 * np.minimum(v["n"][i], v["n"][i + k]) >= similarity * np.maximum(v["n"][i], v["n"][i + k])]
        equal = rows[i] == rows[i + k]
        enough = np.count_nonzero(equal, axis=1) >= least
        i, equal = i[enough], equal[enough]
        if once and len(i):
            i = i[_here(v["order"][i], equal)]
        out.append(np.stack([i, i + k]))
    return np.concatenate(out, 1)


def _linked(pairs: np.ndarray, v: dict[str, np.ndarray], sets: list[np.ndarray], similarity: int) -> np.ndarray:
    """Of pairs of rows with these sets of shingles those that are similar enough and join what was not joined before."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = up = parent.get(up, up)
            x = up
        return x

    roots, sizes = v["root"].tolist(), v["n"].tolist()
    pairs = pairs[:, np.argsort(pairs[0], kind="stable")]
    at = np.flatnonzero(np.append(True, pairs[0, 1:] != pairs[0, :-1])) if pairs.shape[1] else np.zeros(0, np.int64)
    out = []
    for a, z in zip(at.tolist(), [*at[1:].tolist(), pairs.shape[1]], strict=False):
        i = int(pairs[0, a])
        own, others = sets[i], [j for j in pairs[1, a:z].tolist() if root(roots[j]) != root(roots[i])]
        if not others:
            continue
        all_ = np.concatenate([sets[j] for j in others])
        hit = own[np.minimum(np.searchsorted(own, all_), len(own) - 1)] == all_
        starts = np.cumsum([0, *(sizes[j] for j in others[:-1])])
        for j, common in zip(others, np.add.reduceat(hit, starts, dtype=np.int64).tolist(), strict=True):
            x, y = root(roots[i]), root(roots[j])
            if x != y and 100 * common >= similarity * (sizes[i] + sizes[j] - common):
                parent[max(x, y)] = min(x, y)
                out.append((i, j))
    return np.array(out, np.int64).reshape(-1, 2).T


def _neighbours(rows: DataFrame, part: str, reach: int, similarity: int, found: str, edges: bool) -> DataFrame:
    """(a, b) of the sorted rows of each partition, within equal `part`.

    By `found` these are candidate pairs (`pairs`), each row that is in one (`rows`, with a = b), or links confirmed on the
    shingles of the rows (`links`). With `edges` also the first and last `reach` rows of the partition, marked by its number
    and the side.
    """
    columns = {c: t for c, t in (COLUMNS | (SETS if found == "links" else {})).items()}
    numbers = {"order": np.int32, "key": np.int64, "n": np.int64, "root": np.int64}

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        held = first = None

        def edge(rows: pa.Table, side: int) -> Iterator[pa.RecordBatch]:
            none = pa.nulls(rows.num_rows, pa.int64())
            ends = [pa.array(np.full(rows.num_rows, x, np.int32)) for x in (number, side)]
            marked_rows = pa.table([none, none, *ends, *(rows.column(c) for c in columns)], names=["a", "b", "number", "side", *columns])
            yield from marked_rows.combine_chunks().to_batches()

        for batch in stream:
            table = pa.Table.from_batches([batch])
            fresh = held.num_rows if held is not None else 0
            if held is not None:
                table = pa.concat_tables([held, table])
            table = table.combine_chunks()
            v = {c: table.column(c).to_numpy().astype(t) for c, t in numbers.items()}
            v |= {c: table.column(c).to_numpy() for c in ("gap", "side") if c in table.column_names}
            v["rows"] = _matrix(table.column("signature").combine_chunks())
            pairs = _near(v, part, reach, similarity, fresh, found == "links")
            if found == "links":
                lists = table.column("shingles").combine_chunks()
                flat, bounds = lists.flatten().to_numpy().view(np.uint64), lists.offsets.to_numpy() - lists.offsets[0].as_py()
                sets = [flat[x:y] for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                pairs = _linked(pairs, v, sets, similarity)
            elif found == "rows":
                pairs = np.stack([np.unique(pairs)] * 2)
            a, b = (pa.array(v["key"][x]) for x in pairs)
            if edges:
                if first is None:
                    first = True
                    yield from edge(table.slice(0, reach), 0)
                empty = [pa.nulls(len(a), t) for t in (pa.int32(), pa.int32(), *(table.schema.field(c).type for c in columns))]
                yield pa.record_batch([a, b, *empty], names=["a", "b", "number", "side", *columns])
            else:
                yield pa.record_batch([a, b], names=["a", "b"])
            held = table.slice(max(0, table.num_rows - reach)).combine_chunks()
        if edges and held is not None:
            yield from edge(held, 1)

    schema = "a bigint, b bigint" + (", number int, side int, " + _schema(columns) if edges else "")
    return rows.mapInArrow(run, schema)


def candidates(nodes: DataFrame, orders: int, reach: int, similarity: int, found: str) -> DataFrame:
    """(a, b), a <= b, of `nodes` (key, n, root, signature and maybe shingles) that are neighbours in one of the orders: see
    _neighbours() for `found`. Pairs of one root are left out.

    Every order is cut into even ranges, whatever the documents are like; pairs that lie across a cut are found from the rows
    next to it.
    """
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _ordered(nodes, orders)
    ranged = rows.repartitionByRange(parts, "order", "signature", "key").sortWithinPartitions("order", "signature", "key")
    scanned = cut(_neighbours(ranged, "order", reach, similarity, found, True), "neighbours")
    edges = scanned.where("number is not null").drop("a", "b")
    # One row for each partition.
    follows = edges.select("number").distinct().select("number", F.lag("number").over(Window.orderBy("number")).alias("before"))
    gap = F.when(F.col("side") == 1, F.col("number")).otherwise(F.col("before"))
    across = edges.join(follows, "number").withColumn("gap", gap).where("gap is not null").drop("number", "before")
    keyed = across.withColumn("gap", F.col("gap").cast("bigint") * F.lit(ORDERS) + F.col("order"))
    dealt = keyed.repartition(parts, "gap").sortWithinPartitions("gap", "signature", "key")
    pairs = scanned.where("a is not null").select("a", "b").unionByName(_neighbours(dealt, "gap", reach, similarity, found, False))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _place(doc_id: str, text_hash: str) -> F.Column:
    return F.pmod(F.xxhash64(doc_id, text_hash), F.lit(BITS))


def shingle_sets(docs: DataFrame, nodes: DataFrame, keys: DataFrame, shingle: int) -> DataFrame:
    """(key, shingles) of the `nodes` (key, row) whose key is in `keys`: the sorted hashes of their shingles.

    They are made again from the texts: a map of fixed size tells the scan which rows they may be, so no text is shuffled.
    """
    chosen = cut(nodes.join(keys.select("key").distinct(), "key").select("key", "row.*"), "chosen")
    wanted = bitmap(chosen.select(_place("doc_id", "text_hash").alias("place")))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            there = marked(wanted, batch.column("place").to_numpy())
            for part in batches(iter([batch.filter(pa.array(there))])):
                h, offsets = _distinct(*_mixed_shingles(Words(part.column("text")), shingle))
                sets = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(h.view(np.int64)))
                yield pa.record_batch([part.column("doc_id"), part.column("text_hash"), sets], names=["doc_id", "text_hash", "shingles"])

    texts = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), "text")
    sets = texts.withColumn("place", _place("doc_id", "text_hash")).mapInArrow(run, "doc_id bigint, text_hash bigint, shingles array<bigint>")
    same = sets["doc_id"].eqNullSafe(chosen["doc_id"]) & (sets["text_hash"] == chosen["text_hash"])
    # A row that occurs repeatedly has the same set each time.
    return cut(sets.join(chosen, same).groupBy("key").agg(F.first("shingles").alias("shingles")), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The (a, b) of `pairs` whose `sets` (key, shingles) have a Jaccard similarity of `similarity` hundredths or more."""
    met = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    common = F.size(F.array_intersect("x", "y"))
    return met.where(100 * common >= similarity * (F.size("x") + F.size("y") - common)).select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of `docs` (doc_id, text).

    A-Z are lowered, white space parts words; a document's set has its different shingles of `shingle` words, or all its
    words as one if it has fewer. Documents link if their sets have a Jaccard similarity of at least `similarity`
    hundredths. component_id is the smallest doc_id reachable over links, kept tells whether it is the row's own.

    NULL, empty and blank texts have an empty set and link with nothing. Rows of one doc_id are told apart by their texts;
    the rows with equal sets are linked. Rows with a NULL doc_id link like others; a component of such rows only has
    component_id NULL, and kept is false. An empty table gives no rows; other columns are not looked at.
    """
    found = cut(prints(docs, shingle), "minhashes")
    row = F.min(F.struct("doc_id", "text_hash")).alias("row")
    nodes = found.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"), row, F.first("n").alias("n"), F.first("signature").alias("signature"))
    nodes = cut(nodes, "nodes")
    alone = nodes.select("key", "n", F.col("key").alias("root"), "signature")
    pairs = cut(candidates(alone, FIRST_ORDERS, 1, similarity, "pairs"), "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("key"))
    links = cut(confirmed(pairs, shingle_sets(docs, nodes, ends, shingle), similarity), "first-links")
    joined = alone.drop("root").join(components(links).withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    joined = cut(joined, "joined")
    open_ = candidates(joined, ORDERS, REACH, similarity, "rows").select(F.col("a").alias("key"))
    sets = shingle_sets(docs, nodes, open_, shingle)
    more = candidates(joined.join(sets, "key"), ORDERS, REACH, similarity, "links")
    roots = components(links.unionByName(more)).withColumnRenamed("node", "key")
    rooted = cut(nodes.select("key", "least").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("key", "component_id")
    out = found.select("doc_id", F.col("n").alias("n_shingles"), "key").join(named, "key", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
