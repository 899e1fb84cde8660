"""Token ids in a binary format: ids ranked by frequency, coded in one to four bytes, lengths in separate control bytes.

A token file is a folder: `shards` has one binary block a row, in ascending order of doc_id over (bucket, shard), and
`vocabulary` the id of each rank. A block is, all little-endian: magic, number of documents and of ids (three uint32 and
one uint64), then doc_id (int64), a NULL mark (uint8) and the number of ids (uint64) of each document, then the control
bytes (four two-bit lengths each, lowest bits first) and the data bytes. Parquet holds the blocks, so that any file
system Spark can write to will do and lost tasks leave nothing behind.
"""

from __future__ import annotations

import itertools
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.words import U64, Words, batches, mix, raw
from tickloom.session import cut

END_ID = 2
SHARD_IDS = 1 << 20  # a block is closed when it has so many ids
MEMO_PIECES = 1_000_000  # a worker forgets its pieces beyond so many
MAGIC = 0x31465454

# Lengths of the four ids of a control byte.
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1


class Encoder:
    """Encodes whole texts; remembers the ids of words, which byte-level pair coding never joins across.

    A text is cut before single spaces and single line ends; one with other white space is encoded as a whole. Pieces are
    known by a 64-bit hash and kept as arrays: a large sorted one and a small one that is merged into it now and then.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        self.known = [none, none]
        self.flat, self.start, self.size = (_Growing(t) for t in (np.uint32, np.int64, np.int32))

    def _learn(self, pieces: list[str]) -> np.ndarray:
        """Encode pieces, append their ids and return their numbers."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int32, len(found))
        ends = np.cumsum(size, dtype=np.int64)
        number = np.arange(len(found)) + len(self.start)
        self.start.add(ends - size + len(self.flat))
        self.size.add(size)
        self.flat.add(np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(ends[-1]) if len(ends) else 0))
        return number

    def _codes(self, w: Words, keys: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Numbers of the pieces that lie at `first` to `end`."""
        kinds, at, back = np.unique(keys, return_index=True, return_inverse=True)
        code = np.full(len(kinds), -1)
        for known, number in self.known:
            if len(known):
                place = np.minimum(np.searchsorted(known, kinds), len(known) - 1)
                there = known[place] == kinds
                code[there] = number[place[there]]
        new = np.flatnonzero(code < 0)
        if len(new):
            text = w.data.tobytes()
            code[new] = self._learn([text[i:j].decode() for i, j in zip(first[at[new]].tolist(), end[at[new]].tolist(), strict=True)])
            self._remember(1, kinds[new], code[new])
            if 5 * len(self.known[1][0]) > len(self.known[0][0]):
                self._remember(0, *self.known[1])
                self.known[1] = (kinds[:0], code[:0])
        return code[back]

    def _remember(self, level: int, keys: np.ndarray, number: np.ndarray) -> None:
        keys, number = (np.concatenate([x, y]) for x, y in zip(self.known[level], (keys, number), strict=True))
        order = np.argsort(keys, kind="stable")
        self.known[level] = (keys[order], number[order])

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of the texts)."""
        if len(self.start) > MEMO_PIECES:
            self.forget()
        w = Words(column, lower=False)
        n, row = len(w.rows) - 1, w.row_of()
        opens = np.ones(len(row), bool)
        opens[1:] = row[1:] != row[:-1]
        before = np.where(opens, w.offsets[row], np.concatenate([[0], w.end[:-1]]))
        gap, mark = w.first - before, w.data[np.maximum(w.first - 1, 0)]
        plain = np.where(opens, gap == 0, (gap == 1) & ((mark == 0x20) | (mark == 0x0A)))
        last = np.zeros(n, np.int64)
        last[row] = w.end
        whole = (np.bincount(row[~plain], minlength=n) > 0) | (np.where(np.diff(w.rows) > 0, last, w.offsets[:-1]) != w.offsets[1:])
        kind = np.where(opens, 0, np.where(mark == 0x20, 1, 2)).astype(np.uint64)
        use = np.flatnonzero(~whole[row])
        keys = mix(w.hashes()[use] + kind[use] * U64(0xD6E8FEB86659FD93))
        code = self._codes(w, keys, w.first[use] - (kind[use] > 0), w.end[use])
        item_row = row[use]
        if whole.any():
            odd = np.flatnonzero(whole)
            item_row = np.concatenate([item_row, odd])
            order = np.argsort(item_row, kind="stable")
            code, item_row = np.concatenate([code, self._learn([column[i].as_py() for i in odd.tolist()])])[order], item_row[order]
        start, size = self.start.values()[code], self.size.values()[code].astype(np.int64)
        ends = np.cumsum(size)
        ids = self.flat.values()[np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.concatenate([[0], ends])[np.searchsorted(item_row, np.arange(n + 1))]


class _Growing:
    """An array that grows at its end."""

    def __init__(self, kind: type):
        self.held, self.n = np.zeros(1 << 16, kind), 0

    def __len__(self) -> int:
        return self.n

    def add(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.held):
            self.held = np.concatenate([self.held[: self.n], np.zeros(self.n // 2 + 2 * len(values), self.held.dtype)])
        self.held[self.n : self.n + len(values)] = values
        self.n += len(values)

    def values(self) -> np.ndarray:
        return self.held[: self.n]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder a worker process, kept between its tasks."""
    return Encoder(path)


def encoded(batch: pa.RecordBatch, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of the batch's texts, each closed by the end id."""
    ids, bounds = encoder(path)(batch.column("text"))
    n = np.arange(len(bounds))
    out = np.full(len(ids) + len(bounds) - 1, end_id, np.uint32)
    keep = np.ones(len(out), bool)
    keep[bounds[1:] + n[:-1]] = False
    out[keep] = ids
    return out, bounds + n


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of uint32 numbers."""
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    data = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    two = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    two[: len(ranks)] = size - 1
    two = two.reshape(-1, 4)
    return (two[:, 0] | two[:, 1] << 2 | two[:, 2] << 4 | two[:, 3] << 6).astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The `n` numbers that pack() coded."""
    size = _LENGTHS[control].ravel()[:n]
    start = np.cumsum(size, dtype=np.int64) - size
    out = np.zeros(n, np.uint32)
    for k in range(4):
        there = np.flatnonzero(size > k)
        out[there] |= data[start[there] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def _block(docs: list[int | None], counts: list[int], ranks: np.ndarray) -> bytes:
    head = np.array([MAGIC, len(docs), len(ranks) & 0xFFFFFFFF, len(ranks) >> 32], "<u4")
    ids = np.array([d or 0 for d in docs], "<i8")
    null = np.array([d is None for d in docs], np.uint8)
    return b"".join([head.tobytes(), ids.tobytes(), null.tobytes(), np.array(counts, "<u8").tobytes(), *pack(ranks)])


def _parse(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc ids, numbers of ids, ranks) of a block."""
    magic, n, low, high = np.frombuffer(block, "<u4", 4).tolist()
    if magic != MAGIC:
        raise ValueError("not a block of a token file")
    total, at = high << 32 | low, 16
    ids, at = np.frombuffer(block, "<i8", n, at), at + 8 * n
    null, at = np.frombuffer(block, np.uint8, n, at), at + n
    counts, at = np.frombuffer(block, "<u8", n, at).astype(np.int64), at + 8 * n
    n_control = -(-total // 4)
    control, data = np.frombuffer(block, np.uint8, n_control, at), np.frombuffer(block, np.uint8, -1, at + n_control)
    return [None if x else i for i, x in zip(ids.tolist(), null.tolist(), strict=True)], counts, unpack(control, data, total)


def encode(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, tie, ids) of `docs` (doc_id, text): the ids of each text and its end as little-endian numbers.

    They take two bytes each if the vocabulary allows, else four. tie is a hash of the text.
    """
    from tokenizers import Tokenizer

    wide = max(Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True), end_id + 1) > 1 << 16

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream):
            ids, bounds = encoded(batch, tokenizer, end_id)
            flat = ids.astype("<u4" if wide else "<u2")
            rows = pa.BinaryArray.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer((bounds * flat.itemsize).astype(np.int32)), pa.py_buffer(flat)])
            yield pa.record_batch([batch.column("doc_id"), batch.column("tie"), rows], names=["doc_id", "tie", "ids"])

    texts = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("tie"), "text")
    return texts.mapInArrow(run, "doc_id bigint, tie bigint, ids binary").withColumn("wide", F.lit(wide))


def _ids_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of encoded rows."""
    wide = batch.num_rows > 0 and batch.column("wide")[0].as_py()
    data, offsets = raw(batch.column("ids"))
    size = 4 if wide else 2
    return data.view("<u4" if wide else "<u2"), offsets // size


def write_token_file(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode the texts of `docs` (doc_id, text) with the tokenizer at `tokenizer` and write them as a token file.

    Documents are in ascending order of doc_id (NULL first), equal ids in order of a hash of their texts. A NULL text is empty
    and is coded as the end id alone; an empty table writes no block. Other columns are not looked at. Texts are encoded once
    and not shuffled: ids are counted over all documents, then dealt by ranges of doc_id and ranked.
    """
    spark = docs.sparkSession
    coded = cut(encode(docs, tokenizer, end_id), "encoded")

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in stream:
            found = np.bincount(_ids_of(batch)[0], minlength=len(total))
            found[: len(total)] += total
            total = found
        there = np.flatnonzero(total)
        yield pa.record_batch([pa.array(there), pa.array(total[there])], names=["id", "n"])

    # Both tables have at most one row for each id of the vocabulary.
    counted = coded.select("ids", "wide").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    ranked = counted.select((F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1).alias("rank"), "id", "n")
    ranked.coalesce(1).write.parquet(f"{path}/vocabulary")
    vocabulary = spark.read.parquet(f"{path}/vocabulary").toPandas()
    rank_of = np.zeros(int(vocabulary["id"].max()) + 1 if len(vocabulary) else 0, np.uint32)
    rank_of[vocabulary["id"]] = vocabulary["rank"]

    def code(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, shard, before = TaskContext.get().partitionId(), 0, 0
        held: tuple[list, list, list] = ([], [], [])
        size = 0

        def close() -> pa.RecordBatch:
            row = [bucket, shard, before, size, _block(held[0], held[1], np.concatenate(held[2]))]
            return pa.record_batch([pa.array([x]) for x in row], names=["bucket", "shard", "bucket_start", "n_ids", "block"])

        for batch in batches(stream, "ids"):
            ids, bounds = _ids_of(batch)
            held[0].extend(batch.column("doc_id").to_pylist())
            held[1].extend(np.diff(bounds).tolist())
            held[2].append(rank_of[ids])
            size += len(ids)
            if size >= SHARD_IDS:
                yield close()
                shard, before, size = shard + 1, before + size, 0
                for part in held:
                    part.clear()
        if held[0]:
            yield close()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = coded.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "ids")
    schema = "bucket bigint, shard bigint, bucket_start bigint, n_ids bigint, block binary"
    ordered.mapInArrow(code, schema).write.parquet(f"{path}/shards")


def read_token_file(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of each document of a token file; `ids` may be left out.

    start is the number of ids of all documents before it, ids_crc32 the CRC-32 of the ids as little-endian uint32.
    """
    vocabulary = spark.read.parquet(f"{path}/vocabulary").toPandas()
    id_of = np.zeros(len(vocabulary), np.uint32)
    id_of[vocabulary["rank"]] = vocabulary["id"]
    shards = spark.read.parquet(f"{path}/shards")
    # One row for each partition of the writer.
    totals = shards.groupBy("bucket").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = totals.select("bucket", before.alias("offset"))
    placed = shards.join(F.broadcast(offsets), "bucket").select((F.col("offset") + F.col("bucket_start")).alias("start"), "block")

    def decode(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for start, block in zip(batch.column("start").to_pylist(), batch.column("block"), strict=True):
                docs, counts, ranks = _parse(block.as_py())
                values = id_of[ranks].astype("<u4")
                bounds = np.concatenate([[0], np.cumsum(counts)])
                crc = [zlib.crc32(values[a:z]) for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                out = [pa.array(docs, pa.int64()), pa.array(bounds[:-1] + start), pa.array(counts), pa.array(crc, pa.int64())]
                if ids:
                    out.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.astype(np.int32))))
                yield pa.record_batch(out, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(out)])

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * ids
    return placed.mapInArrow(decode, schema)
