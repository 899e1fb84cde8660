"""What the language model's operator leaves on disk, and its packed columns."""

from __future__ import annotations

import os
import random

import numpy as np
import pytest

from tickloom.llm import kneser_ney
from tickloom.session import scratch_root


def size(spark) -> int:
    root = scratch_root(spark).removeprefix("file://")
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(root) for f in files)


def test_no_table_of_n_grams_is_written(spark, monkeypatch):
    """Trusted texts of rare words have about as many different n-grams as words; less than the texts' size is written for them."""
    monkeypatch.setattr(kneser_ney, "BUCKET", 300_000)
    monkeypatch.setattr(kneser_ney, "BLOCK", 600_000)
    rng = random.Random(5)
    rows = [(i, "en", " ".join(f"w{rng.randrange(3000)}" for _ in range(1000))) for i in range(300)]
    docs, labels = spark.createDataFrame(rows, "doc_id bigint, lang string, text string"), spark.createDataFrame([(i, 1, 0) for i in range(300)], "doc_id bigint, quality int, toxic int")
    before, text = size(spark), sum(len(r[2]) for r in rows)
    assert kneser_ney.judge(docs, labels).count() == 300
    assert size(spark) - before < 2 * text
    assert {r.doc_id for r in kneser_ney.keep_good(docs, labels).collect()} == {r.doc_id for r in kneser_ney.judge(docs, labels).where("keep").collect()}


@pytest.mark.parametrize("kind", [kneser_ney.KEYS, *kneser_ney.FEW, np.uint8, np.uint32, np.int64])
def test_packed_columns(kind):
    rng = np.random.default_rng(1)
    for n in (0, 1, 700):
        values = np.sort(rng.integers(0, 200 if kind is np.uint8 else 2**32 - 1, n)).astype(np.uint64)
        values[: n // 3] = 0
        got = kneser_ney._unpack(kneser_ney._pack(values, kind), kind)
        assert got.tolist() == values.tolist()


def test_first_parts_of_keys():
    a, b = np.random.default_rng(2).integers(0, 2**64, (2, 500), dtype=np.uint64)
    assert (kneser_ney._first(kneser_ney._join(a, b), b) == a).all()
