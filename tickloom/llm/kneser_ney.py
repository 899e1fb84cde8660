"""Quality classifier: perplexity under an interpolated modified Kneser-Ney trigram model of all trusted text.

N-grams meet in buckets of their hashes: trigrams in the bucket of their context, which gives the context's totals, then
bigrams in that of their own, then words. Documents are put into packs; a pack asks every bucket for the different n-grams
it holds, in the shuffle in which these are counted, and gets back the counts of those that are known. No task and not the
driver holds a model, and no table of it is written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.llm.words import STEP, U64, Words, batches, mix, sums, unmix
from tickloom.session import cut

BLOCK = 8 << 20  # bytes of text in a pack, about, whose n-grams are counted and asked for together
BUCKET = 16 << 20  # bytes of text for each bucket of n-grams, about
COUNTED = 1 << 20  # bytes of text that are made into n-grams at once
ROUNDS = 4  # parts of the buckets, and of the packs, that are shuffled one after the other
QUANTILE = 0.995  # of the trusted documents' scores in a language; worse documents are rejected
MARGIN = 0.15  # added to the threshold, in log10 per word
PRIOR_WORDS = 20  # words of the language's usual score that every document is credited with, which steadies short ones
EDGE = U64(0x5DEECE66D)  # stands for the two words before a text and the one after it


JOINED = 0xD6E8FEB86659FD93


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * U64(JOINED) + b)


def _trigrams(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(u, v, w, offsets of the rows) of the trigrams of each row, which is closed by EDGE; empty rows have none."""
    h, counts = w.hashes(), np.diff(w.rows)
    n = np.where(counts, counts + 1, 0)
    offsets = np.concatenate([[0], np.cumsum(n)])
    filled = np.flatnonzero(n)
    padded = np.full(len(h) + 3 * len(filled), EDGE, np.uint64)
    shift = np.repeat(np.arange(len(filled)), counts[filled]) * 3 + 2
    padded[np.arange(len(h)) + shift] = h
    at = np.arange(offsets[-1]) + np.repeat(np.arange(len(filled)) * 2, n[filled])
    return padded[at], padded[at + 1], padded[at + 2], offsets


@dataclass
class Model:
    """log10 probabilities and back-off weights by 64-bit n-gram key, keys sorted."""

    tri: tuple[np.ndarray, np.ndarray]
    bi: tuple[np.ndarray, np.ndarray]
    uni: tuple[np.ndarray, np.ndarray]
    back3: tuple[np.ndarray, np.ndarray]
    back2: tuple[np.ndarray, np.ndarray]
    unknown: float

    @staticmethod
    def _find(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, missing: float) -> tuple[np.ndarray, np.ndarray]:
        known, value = table
        if not len(known):
            return np.full(len(keys), missing), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        there = known[at] == keys
        return np.where(there, value[at], missing), there

    def score(self, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        """log10 P(w | u, v) of each trigram."""
        vw = _join(v, w)
        out, seen3 = self._find(self.tri, _join(u, vw), 0.0)
        rest = np.flatnonzero(~seen3)
        p2, seen2 = self._find(self.bi, vw[rest], 0.0)
        out[rest] = p2 + self._find(self.back3, _join(u[rest], v[rest]), 0.0)[0]
        low = rest[~seen2]
        out[low] += self._find(self.uni, w[low], self.unknown)[0] + self._find(self.back2, v[low], 0.0)[0]
        return out


def _discounts(counts: DataFrame, column: str) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more."""
    n = {r[0]: r[1] for r in counts.where(F.col(column) <= 4).groupBy(column).count().collect()}
    return _modified([n.get(k, 0) for k in (1, 2, 3, 4)])


def _modified(sizes: list[int]) -> list[float]:
    """Discounts from how many n-grams occur once, twice, three and four times."""
    n1, n2, n3, n4 = map(float, sizes)
    if not n1 or not n2:
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    out = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.1), k - 0.05) for d, k in zip(out, (1, 2, 3), strict=True)]


def _pick(d: list[float], c: Column) -> Column:
    return F.when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])


def _contexts(counts: DataFrame, by: list[str], column: str, d: list[float]) -> DataFrame:
    """Total and back-off weight of each context."""
    total = F.sum(column)
    return counts.groupBy(*by).agg(total.alias("total"), (F.sum(_pick(d, F.col(column))) / total).alias("gamma"))


def fit(trusted: DataFrame) -> Model:
    """Model of the texts of `trusted` in memory, for small tables. No words give a model in which all are unknown."""

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream):
            u, v, w, _ = _trigrams(Words(batch.column("text"), lower=False))
            yield pa.record_batch([pa.array(x.view(np.int64)) for x in (u, v, w)], names=["u", "v", "w"])

    tokens = trusted.select("text").mapInArrow(count, "u bigint, v bigint, w bigint")
    c3 = cut(tokens.groupBy("u", "v", "w").agg(F.count("*").alias("c")), "trigrams")
    c2 = cut(c3.groupBy("v", "w").agg(F.count("*").alias("c")), "bigrams")
    c1 = cut(c2.groupBy("w").agg(F.count("*").alias("c")), "unigrams")
    d3, d2, d1 = (_discounts(c, "c") for c in (c3, c2, c1))
    total, kinds, gone = c1.agg(F.sum("c"), F.count("*"), F.sum(_pick(d1, F.col("c")))).first()
    if not kinds:
        empty = (np.zeros(0, np.uint64), np.zeros(0))
        return Model(empty, empty, empty, empty, empty, -6.0)
    floor = gone / total / (kinds + 1)
    p1 = c1.select("w", ((F.col("c") - _pick(d1, F.col("c"))) / total + floor).alias("p1"))
    x2, x3 = _contexts(c2, ["v"], "c", d2), _contexts(c3, ["u", "v"], "c", d3)
    share = lambda d: F.greatest(F.col("c") - _pick(d, F.col("c")), F.lit(0.0)) / F.col("total")
    p2 = c2.join(x2, "v").join(p1, "w").select("v", "w", (share(d2) + F.col("gamma") * F.col("p1")).alias("p2"))
    p2 = cut(p2, "bigram-model")
    p3 = c3.join(x3, ["u", "v"]).join(p2, ["v", "w"]).select("u", "v", "w", (share(d3) + F.col("gamma") * F.col("p2")).alias("p3"))

    def table(df: DataFrame, key: tuple[str, ...], value: str) -> tuple[np.ndarray, np.ndarray]:
        """The rows' keys, sorted, and log10 of their values; they come as packed pieces, one partition at a time."""

        def pack(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in stream:
                *rest, last = (batch.column(c).to_numpy().view(np.uint64) for c in key)
                for part in reversed(rest):
                    last = _join(part, last)
                logs = np.log10(batch.column(value).to_numpy()).astype(np.float32)
                yield pa.record_batch([pa.array([last.tobytes()]), pa.array([logs.tobytes()])], names=["key", "value"])

        pieces = [(r.key, r.value) for r in df.select(*key, value).mapInArrow(pack, "key binary, value binary").toLocalIterator()]
        keys = np.frombuffer(b"".join(bytes(k) for k, _ in pieces), np.uint64)
        order = np.argsort(keys)
        return keys[order], np.frombuffer(b"".join(bytes(v) for _, v in pieces), np.float32)[order].astype(float)

    return Model(
        table(p3, ("u", "v", "w"), "p3"),
        table(p2, ("v", "w"), "p2"),
        table(p1, ("w",), "p1"),
        table(x3, ("u", "v"), "gamma"),
        table(x2, ("v",), "gamma"),
        float(np.log10(floor)),
    )


def _planes(values: np.ndarray) -> bytes:
    """Numbers as bytes, lowest bytes of all first: high bytes of counts are mostly zero and compress away."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _numbers(data: np.ndarray, kind: type) -> np.ndarray:
    return np.ascontiguousarray(data.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


KEYS = "keys"  # a column of ascending 64-bit keys, kept as differences
FEW = {"words": np.uint64, "owners": np.uint32}  # columns of numbers that recur, kept as the different ones and places in them


def _pack(values: np.ndarray, kind: type | str) -> bytes:
    """A column as compressed bytes."""
    different = np.zeros(0, np.uint64)
    if kind in FEW:
        different, places = np.unique(values.astype(FEW[kind]), return_inverse=True)
        raw = _planes(np.diff(different, prepend=different.dtype.type(0))) + _planes(places.astype(np.uint32))
    elif kind == KEYS:
        raw = _planes(np.diff(values, prepend=U64(0)))
    else:
        raw = _planes(values.astype(kind))
    return np.array([len(values), len(different)], np.uint32).tobytes() + (pa.compress(raw, "zstd", asbytes=True) if raw else b"")


def _unpack(data: bytes, kind: type | str) -> np.ndarray:
    """The column that _pack() was given."""
    n, m = np.frombuffer(data, np.uint32, 2).tolist()
    number = FEW.get(kind, np.uint64 if kind == KEYS else kind)
    if not n:
        return np.zeros(0, number)
    head = np.dtype(number).itemsize * (m if kind in FEW else n)
    raw = np.frombuffer(pa.decompress(data[8:], head + (4 * n if kind in FEW else 0), "zstd"), np.uint8)
    if kind in FEW:
        return np.cumsum(_numbers(raw[:head], number), dtype=number)[_numbers(raw[head:], np.uint32)]
    found = _numbers(raw, number)
    return np.cumsum(found, dtype=np.uint64) if kind == KEYS else found


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of keys, ascending with them; at most 2^16."""
    return (((keys >> U64(48)) * U64(buckets)) >> U64(16)).astype(np.int64)


def _tri(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Keys of trigrams from those of their contexts, whose buckets they share."""
    return (x & U64(0xFFFF << 48)) | (_join(x, w) >> U64(16))


_PACKED = [f"x{k}" for k in range(7)]
_PIECES = "kind string, bucket bigint, pack bigint, " + ", ".join(f"{c} binary" for c in _PACKED)
_CLASSES = [np.uint32] * 4  # total of a context, its followers that occur once, twice, more often
#: The columns of each kind. Owners are 0 for n-grams of several documents; the last column of an answer tells those of one document only.
_KINDS = {
    "gram": [KEYS, "words", np.uint32, "owners"],  # key of the context, w, count, owner
    "end": [KEYS, "words", "words", "owners"],  # key of (v, w), w, the word before, owner
    "word": [KEYS, np.uint32, *_CLASSES, "owners"],  # hash, words before, as context, owner
    "size": [np.int64],  # n-grams that occur 1, 2, 3 and 4 times, occurrences, n-grams
    "ask": [KEYS],
    "tri": [np.uint8, np.uint32, np.uint8],  # which of the asked are known, then count
    "context": [np.uint8, *_CLASSES, np.uint8],
    "bi": [np.uint8, np.uint32, np.uint8],  # then words before
    "uni": [np.uint8, np.uint32, *_CLASSES, np.uint8],  # then words before, as context
}
ANSWERS = ("tri", "context", "bi", "uni")


def _rows(kind: str, bucket: list[int], pack: list[int | None], rows: list[list[np.ndarray]]) -> pa.RecordBatch:
    """Rows of packed columns. Columns that a kind doesn't have are NULL. A name behind the kind, as in ask-tri, has no effect on them."""
    types = _KINDS[kind.partition("-")[0]]
    packed = [pa.array([_pack(x[i], t) for x in rows], pa.binary()) for i, t in enumerate(types)]
    packed += [pa.nulls(len(rows), pa.binary())] * (len(_PACKED) - len(types))
    keys = [pa.array([kind] * len(rows), pa.string()), pa.array(bucket, pa.int64()), pa.array(pack, pa.int64())]
    return pa.record_batch([*keys, *packed], names=["kind", "bucket", "pack", *_PACKED])


def _pieces(kind: str, bucket: np.ndarray, columns: list[np.ndarray], pack: int | None = None) -> pa.RecordBatch:
    """A row of packed columns for each bucket; `bucket` ascends."""
    at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    ends = np.append(at, len(bucket))[1:]
    return _rows(kind, bucket[at].tolist(), [pack] * len(at), [[c[i:j] for c in columns] for i, j in zip(at, ends, strict=True)])


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by key, first places of the different keys in it, their numbers of rows)."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), ordered[1:] != ordered[:-1]]))
    return order, first, np.diff(np.append(first, len(keys)))


def _added(keys: np.ndarray, columns: list[np.ndarray], owner: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """(different keys in order, sums of the columns, owners, a row of each)."""
    order, first, _ = _runs(keys)
    if not len(keys):
        return keys, columns, owner, order
    owner = owner[order]
    least, most = np.minimum.reduceat(owner, first), np.maximum.reduceat(owner, first)
    return keys[order][first], [np.add.reduceat(c[order], first) for c in columns], np.where(least == most, least, 0).astype(np.uint32), order[first]


def _classes(counts: np.ndarray) -> list[np.ndarray]:
    return [(counts == 1).astype(np.uint32), (counts == 2).astype(np.uint32), (counts > 2).astype(np.uint32)]


def _first(keys: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The first parts of keys that _join() made, from the second."""
    return (unmix(keys) - second) * U64(pow(JOINED, -1, 1 << 64))


def _size(kind: str, counts: np.ndarray) -> pa.RecordBatch:
    found = np.array([*(np.count_nonzero(counts == k) for k in (1, 2, 3, 4)), counts.sum(dtype=np.int64), np.count_nonzero(counts)], np.int64)
    return _rows(f"size-{kind}", [0], [None], [[found]])


_Asks = dict[str, list[tuple[int, np.ndarray]]]


def _answered(kind: str, bucket: int, asks: _Asks, key: np.ndarray, columns: list[np.ndarray], owner: np.ndarray) -> pa.RecordBatch:
    """A row for each pack that asked for any of the keys."""
    packs, rows, values = [], [], [*columns, owner > 0]
    for pack, keys in asks.get(f"ask-{kind}", []) if len(key) else []:
        at = np.minimum(np.searchsorted(key, keys), len(key) - 1)
        known = key[at] == keys
        if known.any():
            packs.append(pack)
            rows.append([np.packbits(known), *(c[at[known]] for c in values)])
    return _rows(kind, [bucket] * len(rows), packs, rows)


def _merged(pieces: DataFrame, finish: Callable[[int, dict[str, list[np.ndarray]], _Asks], Iterator[pa.RecordBatch]]) -> DataFrame:
    """What `finish` makes of a bucket's number, of the columns, by kind, of all its pieces, and of the keys that packs ask for."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, asks = None, {}, {}

        def close() -> Iterator[pa.RecordBatch]:
            whole = {k: [np.concatenate([p[i] for p in parts]) for i in range(len(_KINDS[k]))] for k, parts in held.items()}
            held.clear()
            yield from finish(now, whole, asks)
            asks.clear()

        for batch in stream:
            for r in range(batch.num_rows):
                bucket, kind = batch.column("bucket")[r].as_py(), batch.column("kind")[r].as_py()
                if bucket != now and (held or asks):
                    yield from close()
                now = bucket
                columns = [_unpack(batch.column(c)[r].as_py(), t) for c, t in zip(_PACKED, _KINDS[kind.partition("-")[0]])]
                if kind in _KINDS:
                    held.setdefault(kind, []).append(columns)
                else:
                    asks.setdefault(kind, []).append((batch.column("pack")[r].as_py(), columns[0]))
        if held or asks:
            yield from close()

    return pieces.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, _PIECES)


def _empty(kind: str) -> list[np.ndarray]:
    return [_unpack(_pack(np.zeros(0, np.uint64), t), t) for t in _KINDS[kind]]


@dataclass
class Totals:
    """Discounts of tri, bi and uni by count, and what the words have together."""

    discounts: dict[str, np.ndarray]
    total: int
    words: int
    gone: float  # discounts of all words together

    def values(self, kind: str, x: list[np.ndarray]) -> list[np.ndarray]:
        """What the counts of n-grams give to a probability.

        tri, bi: discounted count; context: total and back-off weight; uni: probability, total and weight as a context.
        """
        cut_ = lambda k, c: np.maximum(c - self.discounts[k][np.minimum(c, 3)], 0)
        if kind in ("tri", "bi"):
            return [cut_(kind, x[0].astype(np.int64))]
        d, (total, *n) = self.discounts["tri" if kind == "context" else "bi"], (c.astype(float) for c in x[-4:])
        weight = (d[1] * n[0] + d[2] * n[1] + d[3] * n[2]) / np.maximum(total, 1)
        own = [cut_("uni", x[0].astype(np.int64)) / self.total + self.floor] if kind == "uni" else []
        return [*own, total, np.where(total > 0, weight, 1.0)]

    @property
    def floor(self) -> float:
        """Probability of a word that the trusted texts don't have."""
        return float(self.gone / self.total / (self.words + 1)) if self.words else 1e-6


def _closed(batch: pa.RecordBatch) -> bytes:
    """Rows as compressed bytes."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _opened(data: pa.Scalar) -> pa.RecordBatch:
    with pa.ipc.open_stream(data.as_buffer()) as rows:
        return rows.read_next_batch()


def _all_trigrams(batch: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """_trigrams() of a batch of any size: (u, v, w, number of trigrams of each row)."""
    parts = []
    for part in batches(iter([batch]), text, COUNTED):
        u, v, w, offsets = _trigrams(Words(part.column(text), lower=False))
        parts.append((u, v, w, np.diff(offsets)))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _different(keys: np.ndarray) -> np.ndarray:
    ordered = np.sort(keys)
    return ordered[np.concatenate([np.ones(min(len(keys), 1), bool), ordered[1:] != ordered[:-1]])]


def _owners(batch: pa.RecordBatch, id_: str, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether its row is trusted, its owner) of each trigram."""
    ids = batch.column(id_).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
    owner = ((mix(ids) >> U64(32)) | U64(1)).astype(np.uint32)
    return np.repeat(batch.column("lm_trusted").to_numpy(zero_copy_only=False), n), np.repeat(owner, n)


def answers(packs: DataFrame, id_: str, text: str, buckets: int) -> tuple[DataFrame, Totals]:
    """(counts of n-grams of the trusted rows for each pack that has them, totals).

    Buckets are gone through in ROUNDS: a round's n-grams and the keys asked of them are shuffled together, and their files
    are gone when its results are written. Tables of n-grams are not written: trigrams meet once by their first two words
    and once by their last two. Only counts of words are, by bucket, on their way to the last step.
    """
    rounds, few = min(ROUNDS, buckets), min(2, buckets)
    step = Callable[[int, pa.RecordBatch], Iterator[pa.RecordBatch]]

    def emit(make: step) -> DataFrame:
        def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in stream:
                for pack, data in zip(batch.column("pack"), batch.column("data"), strict=True):
                    yield from make(pack.as_py(), _opened(data))
                    pa.default_memory_pool().release_unused()

        return packs.select("pack", "data").mapInArrow(run, _PIECES)

    def asks(kind: str, keys: np.ndarray, pack: int) -> pa.RecordBatch:
        keys = _different(keys)
        return _pieces(f"ask-{kind}", _bucket(keys, buckets), [keys], pack)

    def first(now: int) -> step:
        def make(pack: int, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            u, v, w, n = _all_trigrams(batch, text)
            x = _join(u, v)
            here = np.flatnonzero(_bucket(x, buckets) % rounds == now)
            x, w = x[here], w[here]
            yield asks("tri", _tri(x, w), pack)
            yield asks("context", x, pack)
            trusted, owner = (c[here] for c in _owners(batch, id_, n))
            x, w, owner = x[trusted], w[trusted], owner[trusted]
            _, (c,), owner, at = _added(_tri(x, w), [np.ones(len(x), np.uint32)], owner)
            order = np.argsort(x[at], kind="stable")
            at = at[order]
            yield _pieces("gram", _bucket(x[at], buckets), [x[at], w[at], c[order], owner[order]])

        return make

    def second(now: int) -> step:
        def make(pack: int, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            u, v, w, n = _all_trigrams(batch, text)
            y = _join(v, w)
            here = np.flatnonzero(_bucket(y, buckets) % rounds == now)
            u, w, y = u[here], w[here], y[here]
            yield asks("bi", y, pack)
            trusted, owner = (c[here] for c in _owners(batch, id_, n))
            u, w, y = u[trusted], w[trusted], y[trusted]
            _, _, owner, at = _added(_tri(y, u), [], owner[trusted])
            order = np.argsort(y[at], kind="stable")
            at = at[order]
            yield _pieces("end", _bucket(y[at], buckets), [y[at], w[at], u[at], owner[order]])

        return make

    def third(now: int) -> step:
        def make(pack: int, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            _, v, w, _ = _all_trigrams(batch, text)
            both = np.concatenate([v, w])
            yield asks("uni", both[_bucket(both, buckets) % few == now], pack)

        return make

    def trigrams(bucket: int, held: dict[str, list[np.ndarray]], asks: _Asks) -> Iterator[pa.RecordBatch]:
        x, w, c, owner = held.get("gram", _empty("gram"))
        key, (c,), own, at = _added(_tri(x, w), [c], owner)
        yield _size("tri", c)
        yield _answered("tri", bucket, asks, key, [c], own)
        k, sums_, o, _ = _added(x[at], [c, *_classes(c)], own)
        yield _answered("context", bucket, asks, k, sums_, o)

    def bigrams(bucket: int, held: dict[str, list[np.ndarray]], asks: _Asks) -> Iterator[pa.RecordBatch]:
        y, w, u, owner = held.get("end", _empty("end"))
        _, _, own, at = _added(_tri(y, u), [], owner)
        y, w = y[at], w[at]
        key, (n,), own, at = _added(y, [np.ones(len(y), np.uint32)], own)
        w = w[at]
        yield _size("bi", n)
        yield _answered("bi", bucket, asks, key, [n], own)
        one, none = np.ones(len(n), np.uint32), np.zeros(len(n), np.uint32)
        before, after = [w, one, *[none] * 4, own], [_first(key, w), none, n, *_classes(n), own]
        both = [np.concatenate(x) for x in zip(before, after, strict=True)]
        k, sums_, o, _ = _added(both[0], both[1:-1], both[-1])
        yield _pieces("word", _bucket(k, buckets), [k, *sums_, o])

    def unigrams(bucket: int, held: dict[str, list[np.ndarray]], asks: _Asks) -> Iterator[pa.RecordBatch]:
        x = held.get("word", _empty("word"))
        k, sums_, o, _ = _added(x[0], x[1:-1], x[-1])
        yield _size("uni", sums_[0])
        yield _answered("uni", bucket, asks, k, sums_, o)

    def together(frames: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, frames)

    c3 = together([cut(_merged(emit(first(r)), trigrams), "trigrams", free=True) for r in range(rounds)])
    c2 = together([cut(_merged(emit(second(r)), bigrams), "bigrams", free=True) for r in range(rounds)])
    words = lambda r: c2.where(f"kind = 'word' and bucket % {few} = {r}")
    c1 = together([cut(_merged(words(r).unionByName(emit(third(r))), unigrams), "unigrams", free=True) for r in range(few)])
    all_ = together([c3, c2, c1])
    sizes = {k: np.zeros(6, np.int64) for k in ("tri", "bi", "uni")}
    for r in all_.where("kind like 'size-%'").select("kind", "x0").toLocalIterator():  # a row for each bucket
        sizes[r.kind[5:]] += _unpack(bytes(r.x0), np.int64)
    discounts = {k: np.array([0.0, *_modified(x[:4].tolist())]) for k, x in sizes.items()}
    n1, n2, _, _, total, words_ = sizes["uni"].tolist()
    gone = float(np.array([n1, n2, words_ - n1 - n2]) @ discounts["uni"][1:])
    return all_.where(F.col("kind").isin(*ANSWERS)), Totals(discounts, total, words_, gone)


class _Known:
    """Values of the n-grams of a pack that the trusted texts have."""

    def __init__(self, asked: dict[str, np.ndarray], buckets: int, answers: pa.Table, totals: Totals):
        edges = {k: np.searchsorted(_bucket(keys, buckets), np.arange(buckets + 1)) for k, keys in asked.items()}
        key = {k: [np.zeros(0, np.uint64)] for k in asked}
        value = {k: [_empty(k)[1:]] for k in asked}
        for kind, b, *columns in zip(*(answers.column(c) for c in ("kind", "bucket", *_PACKED)), strict=True):
            kind, b = kind.as_py(), b.as_py()
            own = asked[kind][edges[kind][b] : edges[kind][b + 1]]
            known, *found = (_unpack(c.as_py(), t) for c, t in zip(columns, _KINDS[kind]))
            key[kind].append(own[np.unpackbits(known, count=len(own)).astype(bool)])
            value[kind].append(found)
        self.found = {}
        for kind in asked:
            keys, columns = np.concatenate(key[kind]), [np.concatenate(x) for x in zip(*value[kind], strict=True)]
            order = np.argsort(keys)
            self.found[kind] = keys[order], columns[-1][order].astype(bool), totals.values(kind, [c[order] for c in columns[:-1]])

    def get(self, kind: str, keys: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """(whether they count as known, values) of n-grams; `own` marks those of trusted documents, which must have been seen in another."""
        key, alone, value = self.found[kind]
        if not len(key):
            return np.zeros(len(keys), bool), [np.zeros(len(keys)) for _ in value]
        at = np.minimum(np.searchsorted(key, keys), len(key) - 1)
        return (key[at] == keys) & ~(own & alone[at]), [v[at] for v in value]

    def score(self, x: np.ndarray, v: np.ndarray, w: np.ndarray, own: np.ndarray, floor: float) -> np.ndarray:
        """log10 P(w | u, v) of each trigram; `x` is the key of u and v."""
        known1, (p1, _, _) = self.get("uni", w, own)
        context1, (_, total2, weight2) = self.get("uni", v, own)
        known2, (n2,) = self.get("bi", _join(v, w), own)
        context2, (total3, weight3) = self.get("context", x, own)
        known3, (n3,) = self.get("tri", _tri(x, w), own)
        p = np.where(known1, p1, floor)
        context1 &= total2 > 0
        p = np.where(context1, weight2 * p + np.where(known2, n2, 0) / np.maximum(total2, 1), p)
        context2 &= total3 > 0
        p = np.where(context2, weight3 * p + np.where(known3, n3, 0) / np.maximum(total3, 1), p)
        return np.log10(p)


class Packs:
    """The rows of `docs` in compressed packs, written once, and what the model of all trusted documents says of them."""

    def __init__(self, docs: DataFrame, labels: DataFrame):
        self.names, size = docs.columns, docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        plain = docs.toDF(*[f"c{k}" for k in range(len(self.names))])
        id_, text = (f"c{self.names.index(c)}" for c in ("doc_id", "text"))
        rows = plain.withColumn("id", F.col(id_).cast("bigint")).join(trusted_ids(labels).select(F.col("doc_id").alias("id"), F.lit(True).alias("lm_trusted")), "id", "left")
        rows = rows.select(*plain.columns, F.coalesce("lm_trusted", F.lit(False)).alias("lm_trusted"))

        def close(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches(stream, text, BLOCK):
                yield pa.record_batch([pa.array([_closed(batch)], pa.binary())], names=["data"])

        self.schema, self.text = rows.schema, text
        self.packs = cut(rows.mapInArrow(close, "data binary").select(F.monotonically_increasing_id().alias("pack"), "data"), "packs", free=True)
        self.buckets = int(size // BUCKET) + 1 if size < BUCKET else max(int(size // BUCKET) + 1, 8 * ROUNDS)
        self.found, self.totals = answers(self.packs, id_, text, self.buckets)

    def scored(self, columns: list[str], part: str = "true") -> DataFrame:
        """(lm_pack, lm_row, the named columns, lm_trusted, lm_words, lm_log10) of each row of the packs in `part`."""
        kept = [f"c{self.names.index(c)}" for c in columns]
        text, buckets, totals, all_ = self.text, self.buckets, self.totals, [*kept, "lm_trusted"]

        def judge_pack(table: pa.Table, found: pa.Table) -> pa.Table:
            out = []
            for pack, data in zip(table.column("pack"), table.column("data"), strict=True):
                whole = _opened(data)
                u, v, w, n = _all_trigrams(whole, text)
                x = _join(u, v)
                asked = {"tri": _tri(x, w), "context": x, "bi": _join(v, w), "uni": np.concatenate([v, w])}
                known = _Known({k: _different(c) for k, c in asked.items()}, buckets, found, totals)
                own, logs = np.repeat(whole.column("lm_trusted").to_numpy(zero_copy_only=False), n), np.zeros(len(x))
                for at in range(0, len(x), STEP // 8):
                    part = slice(at, at + STEP // 8)
                    logs[part] = known.score(x[part], v[part], w[part], own[part], totals.floor)
                logs = sums(logs, np.concatenate([[0], np.cumsum(n)]))
                keys = [pa.array([pack.as_py()] * len(n), pa.int64()), pa.array(np.arange(len(n)))]
                out.append(pa.record_batch([*keys, *(whole.column(c) for c in all_), pa.array(n), pa.array(logs)], names=["pack", "row", *all_, "lm_words", "lm_log10"]))
            return pa.Table.from_batches(out)

        schema = StructType().add("pack", "long").add("row", "long")
        for c in all_:
            schema.add(self.schema[c])
        schema.add("lm_words", "long").add("lm_log10", "double")
        found = self.found.where(part).groupBy("pack")
        return self.packs.where(part).groupBy("pack").cogroup(found).applyInArrow(judge_pack, schema).toDF("lm_pack", "lm_row", *columns, "lm_trusted", "lm_words", "lm_log10")

    def scored_in_rounds(self, columns: list[str]) -> DataFrame:
        """scored() of all packs, written in rounds; `columns` should not name the texts."""
        rounds = min(ROUNDS, self.buckets)
        return reduce(DataFrame.unionByName, [cut(self.scored(columns, f"pmod(xxhash64(pack), {rounds}) = {r}"), "scored", free=True) for r in range(rounds)])

    def rows(self, kept: DataFrame) -> DataFrame:
        """The rows with the (lm_pack, lm_row) of `kept`."""
        schema = StructType(self.schema.fields[: len(self.names)])

        def pick(table: pa.Table, kept: pa.Table) -> pa.Table:
            return pa.Table.from_batches([_opened(data).select(schema.names).take(kept.column("lm_row").combine_chunks()) for data in table.column("data")])

        return self.packs.groupBy("pack").cogroup(kept.select("lm_pack", "lm_row").groupBy("lm_pack")).applyInArrow(pick, schema).toDF(*self.names)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs`, all columns, with lm_trusted, lm_words (words and the end of the text) and lm_log10 (of the text's probability).

    The model is that of all trusted documents; for a trusted document that of all others: an n-gram counts as unseen there
    if no other trusted doc_id has it. Rows are written once in compressed packs, which ask for their n-grams.
    """
    return Packs(docs, labels).scored(docs.columns).drop("lm_pack", "lm_row")


def per_word(usual: Column) -> Column:
    """Score of a document: mean log10 probability of a word, PRIOR_WORDS words at the language's usual mean added."""
    return (F.col("lm_log10") + PRIOR_WORDS * usual) / (F.col("lm_words") + PRIOR_WORDS)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_id of the rows with quality 1; a doc_id that also has another quality is not trusted."""
    return labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min("quality").alias("q")).where("q = 1").select("doc_id")


def thresholds(scored: DataFrame) -> DataFrame:
    """(lang, usual, threshold) by language, and for all together as NULL, from all trusted documents of score().

    `usual` is the median of lm_log10 / lm_words; documents whose per_word() is under `threshold` are rejected.
    """
    good = scored.where("lm_words > 0 and lm_trusted").select("lang", "lm_words", "lm_log10")
    both = cut(good.where("lang is not null").unionByName(good.withColumn("lang", F.lit(None).cast("string"))), "trusted")
    usual = both.groupBy("lang").agg(F.percentile_approx(F.col("lm_log10") / F.col("lm_words"), 0.5).alias("usual"))
    scores = both.withColumnRenamed("lang", "of").join(usual, F.col("of").eqNullSafe(F.col("lang")))
    threshold = F.percentile_approx(per_word(F.col("usual")), 1 - QUANTILE, 100_000) - MARGIN
    return scores.groupBy("lang").agg(F.first("usual").alias("usual"), threshold.alias("threshold"))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, lang, lm_words, lm_log10, perplexity, score, threshold, keep) of each row of `docs`.

    Words are split at white space, case kept. perplexity is that of the document alone; score is per_word(). A document
    is kept if its score reaches the threshold of its language, or of all languages where its own has no trusted document
    or is NULL; without any trusted document all are kept. NULL and empty texts have no words, a NULL perplexity and are
    rejected. Repeated rows give repeated rows.
    """
    scored = Packs(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "text"), labels).scored_in_rounds(["doc_id", "lang"])
    return judged(scored.drop("lm_pack", "lm_row", "lm_trusted"), thresholds(scored))


def judged(scored: DataFrame, limits: DataFrame) -> DataFrame:
    """`scored` with perplexity, score, threshold and keep."""
    limits = {r.lang: (r.usual, r.threshold) for r in limits.collect()}  # one row for each language
    usual, threshold = limits.pop(None, (0.0, None))
    own = lambda k, other: F.coalesce(F.create_map(*[F.lit(x) for lang, v in limits.items() for x in (lang, v[k])])[F.col("lang")] if limits else F.lit(None), F.lit(other).cast("double"))
    out = scored.withColumn("perplexity", F.when(F.col("lm_words") > 0, F.pow(F.lit(10.0), -F.col("lm_log10") / F.col("lm_words"))))
    out = out.withColumns({"score": F.when(F.col("lm_words") > 0, per_word(own(0, usual))), "threshold": own(1, threshold)})
    return out.withColumn("keep", F.coalesce(F.col("score") >= F.coalesce("threshold", F.lit(float("-inf"))), F.lit(False)))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, that judge() keeps."""
    packs = Packs(docs, labels)
    scored = packs.scored_in_rounds(["lang"])
    return packs.rows(judged(scored, thresholds(scored)).where("keep"))
