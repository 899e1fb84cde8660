"""Periodic runs of words: maximal stretches that repeat with some period.

The period of a run is the length of a Lyndon word that begins in it and is the longest one there, under one of two opposite
orders of the words. A suffix sorter's first phase, which groups suffixes by their longest Lyndon prefix, gives those
lengths directly. Each is a candidate root, extended to both sides by longest common extensions.

Before that, words that do not recur between two such words of their text are taken out again and again: no run holds one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.words import Words, batches

LEAST = 12  # words of the shortest run


def stretches(word: np.ndarray, row: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, stretch of each): the words that may lie in a run, in stretches of `least` or more neighbours.

    Every word of a run recurs in it, a period before or behind, so a word that is alone in its stretch parts it.
    """
    at, part = np.arange(len(word)), row
    while len(at):
        kinds = part.astype(np.int64) * (int(word.max()) + 1) + word[at]
        _, back, counts = np.unique(kinds, return_inverse=True, return_counts=True)
        kept = counts[back] > 1
        before, at, part = len(at), at[kept], part[kept]
        opens = np.ones(len(at), bool)
        opens[1:] = (part[1:] != part[:-1]) | (at[1:] != at[:-1] + 1)
        part = np.cumsum(opens) - 1
        long = np.bincount(part, minlength=1)[part] >= least if len(part) else opens
        at, part = at[long], part[long]
        if len(at) == before:
            break
    return at, part


def lyndon_lengths(letters: list[int]) -> list[int]:
    """Length of the longest Lyndon word that begins at each place; 0 marks the end of a stretch, which none crosses.

    Suffixes lie in groups of a common prefix, at first their letter. Groups are taken from the highest to the lowest. When a
    group is taken, its prefix is the longest Lyndon prefix of its members. The nearest place before a member whose group is
    still lower continues with that prefix: it moves to a group right above its own, the higher the more members follow it.
    """
    n, kinds = len(letters), sorted(set(letters) - {0})
    number = {x: g for g, x in enumerate(kinds, 1)}
    group = [number.get(x, 0) for x in letters]
    members: list[list[int]] = [[] for _ in range(len(kinds) + 1)]
    for i, g in enumerate(group):
        members[g].append(i)
    length, above, below = [1] * len(members), list(range(1, len(members) + 1)), list(range(-1, len(members) - 1))
    above[-1] = -1
    lengths, taken_from = [0] * n, list(range(-1, n - 1))
    taken = len(kinds)
    while taken > 0:
        size = length[taken]
        own = [i for i in members[taken] if group[i] == taken]
        for i in own:
            lengths[i] = size
        followers: dict[int, int] = {}
        for i in own:
            # Places that were taken point further back; paths are halved on the way.
            p = taken_from[i]
            while p >= 0 and lengths[p]:
                q = taken_from[p]
                if q >= 0 and lengths[q]:
                    taken_from[p] = q = taken_from[q]
                p = q
            taken_from[i] = p
            if p >= 0 and group[p]:
                followers[p] = followers.get(p, 0) + 1
        moves: dict[tuple[int, int], list[int]] = {}
        for p, k in followers.items():
            moves.setdefault((k, group[p]), []).append(p)
        # Fewer followers come later, so their group ends up closer above the old one.
        for k, g in sorted(moves, reverse=True):
            new, up = len(members), above[g]
            members.append(moves[k, g])
            length.append(length[g] + k * size)
            above.append(up)
            below.append(g)
            above[g] = new
            if up >= 0:
                below[up] = new
            for p in moves[k, g]:
                group[p] = new
        taken = below[taken]
    return lengths


class Extensions:
    """Longest common extensions of places of a text, from names of all its pieces of 1, 2, 4, ... letters."""

    def __init__(self, letters: np.ndarray, longest: int):
        self.names = [np.unique(letters, return_inverse=True)[1]]
        while (step := 1 << len(self.names) - 1) < longest and len(letters) > step:
            a = self.names[-1]
            self.names.append(np.unique(a[:-step] * len(letters) + a[step:], return_inverse=True)[1])

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many letters from places `a` on equal those from `b` on, `b` being the later place."""
        total = np.zeros(len(a), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            x, y = a + total, b + total
            fits = np.flatnonzero(y < len(self.names[k]))
            same = fits[self.names[k][x[fits]] == self.names[k][y[fits]]]
            total[same] += 1 << k
        return total

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many letters back from places `a`, which may be -1, equal those back from `b`."""
        total = np.zeros(len(a), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            x, y = a - total - (1 << k) + 1, b - total - (1 << k) + 1
            fits = np.flatnonzero((x >= 0) & (y < len(self.names[k])))
            same = fits[self.names[k][x[fits]] == self.names[k][y[fits]]]
            total[same] += 1 << k
        return total


def runs_of(word: np.ndarray, row: np.ndarray, least: int = LEAST) -> np.ndarray:
    """(start, length, period) of all runs of `least` or more words, in order; `start` counts over all rows.

    `word` are the numbers of the words, `row` the text of each, in order.
    """
    at, part = stretches(word, row, least)
    if not len(at):
        return np.zeros((0, 3), np.int64)
    # Each stretch is closed by an end that occurs nowhere else.
    ends = np.flatnonzero(np.append(part[1:] != part[:-1], True))
    place = np.arange(len(at)) + part - part[0]
    letters = np.zeros(len(at) + len(ends), np.int64)
    letters[place] = word[at] + 1
    closing = np.flatnonzero(letters == 0)
    origin = np.zeros(len(letters), np.int64)
    origin[place] = at
    top = int(letters.max()) + 1
    first, period = [], []
    for order in (letters, np.where(letters > 0, top - letters, 0)):
        found = np.array(lyndon_lengths(order.tolist()), np.int64)
        first.append(place)
        period.append(found[place])
    begin, period = np.unique(np.stack([np.concatenate(first), np.concatenate(period)]), axis=1)
    letters[closing] = top + np.arange(len(closing))
    extend = Extensions(letters, int(np.bincount(part).max()))
    back, forth = extend.left(begin - 1, begin + period - 1), extend.right(begin, begin + period)
    length = back + period + forth
    long = (length >= 2 * period) & (length >= least)
    return np.unique(np.stack([origin[(begin - back)[long]], length[long], period[long]], 1), axis=0)


def _joined(w: Words, keep: np.ndarray) -> pa.StringArray:
    """The kept words of each row, joined by one space."""
    first, size, row = w.first[keep], (w.end - w.first)[keep], w.row_of()[keep]
    last = np.ones(len(row), bool)
    last[:-1] = row[1:] != row[:-1]
    wide = size + ~last
    stop = np.cumsum(wide)
    out = np.full(int(stop[-1]) if len(stop) else 0, 0x20, np.uint8)
    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(stop - wide, size) + step] = w.data[np.repeat(first, size) + step]
    bounds = np.concatenate([[0], stop])[np.searchsorted(row, np.arange(len(w.rows)))]
    return pa.StringArray.from_buffers(len(w.rows) - 1, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(out))


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of each row of `docs` (doc_id, text).

    White space parts words. A run is a stretch of words that equal those q places further on, q being the smallest such
    period, that is at least `least` and 2 q words long and grows at neither end; runs are (start, length, period) in order,
    start counting words from 0. collapsed has the words, joined by one space, without those that lie in a run behind its
    first q words. A NULL or empty text has no words, no runs and an empty collapsed text; an empty table gives no rows. Rows
    are judged one by one, repeated or not, whatever their doc_id; other columns are not looked at.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream):
            w = Words(batch.column("text"), lower=False)
            found = runs_of(w.coded().indices.to_numpy(), w.row_of(), least)
            start, length, period = found.T
            inside = np.zeros(len(w.first) + 1, np.int64)
            np.add.at(inside, start + period, 1)
            np.add.at(inside, start + length, -1)
            row = np.searchsorted(w.rows, start, "right") - 1
            fields = [pa.array(x) for x in (start - w.rows[row], length, period)]
            bounds = pa.array(np.searchsorted(start, w.rows), pa.int32())
            runs = pa.ListArray.from_arrays(bounds, pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
            out = [batch.column("doc_id"), pa.array(np.diff(w.rows)), runs, _joined(w, np.cumsum(inside)[:-1] == 0)]
            yield pa.record_batch(out, names=["doc_id", "n_words", "runs", "collapsed"])

    schema = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)
