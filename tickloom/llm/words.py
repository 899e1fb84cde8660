"""Words of Arrow text columns as numpy arrays: the UTF-8 bytes are read in place, no string objects are made."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

U64 = np.uint64
STEP = 1 << 20  # bytes of text handled at once, so that the arrays made of them stay small

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PUNCTUATION = _SPACE.copy()
_PUNCTUATION[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash (splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def unmix(x: np.ndarray) -> np.ndarray:
    """What mix() was given."""
    x = (x ^ (x >> U64(31)) ^ (x >> U64(62))) * U64(pow(0x94D049BB133111EB, -1, 1 << 64))
    x = (x ^ (x >> U64(27)) ^ (x >> U64(54))) * U64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return x ^ (x >> U64(30)) ^ (x >> U64(60))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U64(0x9E3779B97F4A7C15))
_R = 0x9E3779B97F4A7C15
_RINV = pow(_R, -1, 1 << 64)
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        for k, r in (("up", _R), ("down", _RINV)):
            a = np.full(n, r, np.uint64)
            a[0] = 1
            _POWERS[k] = np.cumprod(a, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def batches(stream: Iterator[pa.RecordBatch], column: str = "text", step: int = STEP) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of at most `step` bytes of text, or one row."""
    for batch in stream:
        _, offsets = raw(batch.column(column))
        at, n = 0, batch.num_rows
        while at < n:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + step, "right")) - 1)
            yield batch.slice(at, min(end, n) - at)
            at = end
        pa.default_memory_pool().release_unused()


def filter_rows(docs: DataFrame, keep: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """The rows of `docs` for which `keep` of their batch is true, with all columns, whatever their names."""
    names = docs.columns
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])
    text = f"c{names.index('text')}"

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream, text):
            yield batch.filter(pa.array(keep(batch.rename_columns(names)), pa.bool_()))

    return plain.mapInArrow(run, plain.schema).toDF(*names)


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a text column; NULL is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(column) else np.zeros(0, np.uint8)
    return data, offsets - (offsets[0] if len(offsets) else 0)


class Words:
    """Words `[^\\x20\\x09-\\x0D]+` of the rows: `first`, `end` are byte places in `data`, `rows` the word offsets of the rows.

    With `bare` ASCII punctuation parts words as white space does; `parting` marks other bytes that part them instead.
    """

    def __init__(self, column: pa.Array, lower: bool = True, bare: bool = False, parting: np.ndarray | None = None):
        data, self.offsets = raw(column)
        self.data = _LOWER[data] if lower else data
        space = (parting if parting is not None else _PUNCTUATION if bare else _SPACE)[data]
        n = len(data)
        before = np.ones(n, bool)
        before[1:] = space[:-1]
        before[self.offsets[:-1][self.offsets[:-1] < n]] = True
        after = np.ones(n, bool)
        after[:-1] = before[1:] | space[1:]
        inside = ~space
        self.first = np.flatnonzero(inside & before)
        self.end = np.flatnonzero(inside & after) + 1
        self.rows = np.searchsorted(self.first, self.offsets)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        up, down = _powers(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        total[1:] = _BYTE[self.data]
        total[1:] *= up[:-1]
        np.cumsum(total, out=total)
        return mix((total[self.end] - total[self.first]) * down[self.first])

    def coded(self) -> pa.DictionaryArray:
        """The words themselves, each known by its number in a dictionary."""
        marks = np.zeros(len(self.data) + 1, np.int8)
        marks[self.first] += 1
        marks[self.end] -= 1
        inside = np.cumsum(marks, dtype=np.int8)[:-1].astype(bool)
        flat = np.zeros(len(self.first) + 1, np.int32)
        np.cumsum(self.end - self.first, out=flat[1:])
        return pa.StringArray.from_buffers(len(self.first), pa.py_buffer(flat), pa.py_buffer(self.data[inside])).dictionary_encode()

    def row_of(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of `values` between neighbouring offsets, 0 where there are none."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]
