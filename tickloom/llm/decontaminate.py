"""Benchmark decontamination by spaced seeds.

A mask such as 110110111 hashes the words at its ones and ignores those at its zeros, so a hit survives substituted
words at the ignored places. The hashes of a benchmark block meet those of every document inside the scan of the
documents, and the diagonal of each hit is then compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.words import U64, Words, batches, filter_rows, mix

#: Every shortest overlap that meets the rule below, wherever its substituted words are, holds one of these.
MASKS = ("1101100111", "11100101011", "110100110011", "1011111", "1111011")
MIN_WORDS = 13  # equal words of an overlap, or all words of a shorter item
SHORTEST = 5  # items of fewer words would match ordinary prose and are not searched
MISMATCH = 4  # equal words that one substituted word costs: overlaps have more than 4 in 5 equal
BLOCK_WORDS = 500_000  # benchmark words shipped to the tasks at once, or one item; more make more passes

PAIRS = "doc_id bigint, item_id bigint, doc_start bigint, item_start bigint, n_words bigint, n_equal bigint, item_words bigint"


def _spaced(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash of every window of `mask` over the words."""
    n = len(words) - len(mask) + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            out = (out + words[k : k + n]) * U64(0xD6E8FEB86659FD93)
    return mix(out + U64(len(mask) * 131 + mask.count("1")))


def _stretch(equal: np.ndarray) -> tuple[int, int, int]:
    """(start, end, equal words) of the stretch with most equal words of those with over MISMATCH equal ones for each
    substituted one; of several the shortest, then the first. It begins and ends with an equal word."""
    score = np.concatenate([[0], np.cumsum(np.where(equal, 1, -MISMATCH))])
    many = np.concatenate([[0], np.cumsum(equal)])
    # The farthest start for each end is the first place whose score is below that of the end.
    begin = np.searchsorted(-np.minimum.accumulate(score), -score, "right")
    end = np.flatnonzero(begin < np.arange(len(score)))
    if not len(end):
        return 0, 0, 0
    begin = begin[end]
    most = many[end] - many[begin]
    best = most == most.max()
    begin, end = begin[best], end[best]
    place = np.flatnonzero(equal)
    first, last = place[many[begin]], place[many[end] - 1] + 1
    k = np.lexsort((first, last - first))[0]
    return int(first[k]), int(last[k]), int(most.max())


class Block:
    """Benchmark items, (item_id, hashes of their words) each, with their seed hashes, sorted."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]]):
        self.items = items
        lengths = {len(w) for _, w in items if len(w) < max(map(len, MASKS))}
        self.masks = (*MASKS, *("1" * n for n in sorted(lengths)))
        self.tables = []
        for mask in self.masks:
            found = [
                (h, np.full(len(h), i), np.arange(len(h)))
                for i, (_, w) in enumerate(items)
                if set(mask) != {"1"} or len(mask) == len(w)
                for h in [_spaced(w, mask)]
            ]
            h, item, at = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.uint64), np.zeros(0, int), np.zeros(0, int))
            order = np.argsort(h, kind="stable")
            gate = np.zeros(1 << 20, bool)
            gate[(h >> U64(44)).astype(np.int64)] = True
            self.tables.append((h[order], item[order], at[order], gate))

    def hits(self, words: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Distinct (row, item, diagonal) of the seed hits, as three columns; a diagonal is document place less item place."""
        out = []
        row_of = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
        for mask, (h, item, at, gate) in zip(self.masks, self.tables, strict=True):
            mine = _spaced(words, mask)
            if not len(mine) or not len(h):
                continue
            here = np.flatnonzero(gate[(mine >> U64(44)).astype(np.int64)])
            here = here[row_of[here] == row_of[here + len(mask) - 1]]
            left, right = np.searchsorted(h, mine[here], "left"), np.searchsorted(h, mine[here], "right")
            count = right - left
            place = np.repeat(here, count)
            k = np.repeat(left, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            row = row_of[place]
            out.append(np.stack([row, item[k], place - rows[row] - at[k]], 1))
        return np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 3), np.int64)

    def overlaps(self, words: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int, int, int, int, int, int]]:
        """(row, item, document start, item start, words, equal words, item words) of the verified overlaps."""
        for row, i, diagonal in self.hits(words, rows).tolist():
            item, theirs = self.items[i]
            mine = words[rows[row] : rows[row + 1]]
            lo, hi = max(0, -diagonal), min(len(theirs), len(mine) - diagonal)
            start, end, n_equal = _stretch(theirs[lo:hi] == mine[lo + diagonal : hi + diagonal])
            if n_equal >= min(MIN_WORDS, len(theirs)):
                yield row, item, start + lo + diagonal, start + lo, end - start, n_equal, len(theirs)


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, np.ndarray]]]:
    """Benchmark items in blocks of about BLOCK_WORDS words; each block, and no more, is brought to the driver."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    items = benchmark.select("item_id", words.alias("words")).where(F.size("words") >= SHORTEST)
    total = items.agg(F.sum(F.size("words"))).first()[0] or 0
    n = -(-total // BLOCK_WORDS)
    block = F.pmod(F.xxhash64("item_id", "words"), F.lit(n))
    for k in range(n):
        yield [(r.item_id, Words(pa.array([" ".join(r.words)])).hashes()) for r in items.where(block == k).distinct().toLocalIterator()]


def find_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Benchmark overlaps of the documents: the longest one of each (doc_id, item_id).

    `docs` needs doc_id and text, `benchmark` item_id and text; other columns are not looked at. Words are split at
    white space, A-Z in lower case. A pair counts if MIN_WORDS words (all, if the item is shorter) are equal in an
    overlap of which more than four fifths of the words are equal. NULL and empty texts, and items of fewer than
    SHORTEST words, match nothing; repeated rows give their pair once; empty tables give no rows. A row with a NULL
    doc_id or item_id keeps the NULL.

    Documents are never shuffled. The benchmark goes to the tasks in blocks of a fixed number of words, one pass over
    the documents a block, whatever its size.
    """
    out = None
    for items in _blocks(benchmark):
        block = Block(items)

        def run(stream: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            schema = pa.schema([(x.split()[0], pa.int64()) for x in PAIRS.split(", ")])
            for batch in batches(stream):
                w = Words(batch.column("text"))
                found = list(block.overlaps(w.hashes(), w.rows))
                ids = batch.column("doc_id")
                columns = [[ids[r[0]].as_py() for r in found], *([r[k] for r in found] for k in range(1, 7))]
                yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], schema=schema)

        found = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, PAIRS)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], PAIRS)
    best = F.max_by(F.struct("doc_start", "item_start", "n_words", "n_equal", "item_words"), F.struct("n_equal", -F.col("n_words"), -F.col("doc_start"), -F.col("item_start")))
    return out.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, that overlap no benchmark item (see find_overlaps). One scan, no shuffle."""
    for items in _blocks(benchmark):
        block = Block(items)

        def keep(batch: pa.RecordBatch, block: Block = block) -> np.ndarray:
            w = Words(batch.column("text"))
            clean = np.ones(batch.num_rows, bool)
            clean[[r[0] for r in block.overlaps(w.hashes(), w.rows)]] = False
            return clean

        docs = filter_rows(docs, keep)
    return docs
