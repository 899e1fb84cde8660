"""Document fingerprints by spot signatures: chains of content words that follow common words."""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.words import U64, Words, batches, mix
from tickloom.session import cut

CHAIN = 2  # content words of a signature
GAP = 8  # content words after an anchor, or the text's beginning, beyond which every word is an anchor up to the next

# Frequent function words of English, French, German and Spanish, the anchors of the signatures.
ANCHORS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the",
    "this", "to", "was", "with", "au", "avec", "dans", "de", "des", "du", "en", "est", "et", "la", "le", "les", "ou",
    "par", "pas", "pour", "que", "qui", "sur", "un", "une", "auf", "das", "dem", "den", "der", "die", "ein", "eine",
    "er", "es", "ist", "mit", "nicht", "sich", "sie", "und", "von", "zu", "con", "del", "el", "las", "los", "no", "para",
    "por", "se", "su", "una", "y",
)
_ANCHORS = np.sort(Words(pa.array([" ".join(ANCHORS)])).hashes())


def signatures(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct signatures (uint32) of each text.

    A-Z are lowered; white space and ASCII punctuation part words. A signature is an anchor and the CHAIN content words
    that follow it, other anchors skipped. Stretches of content words only are anchored at every word past GAP. A text in which no anchor has its chain is signed by its single words instead.
    NULL and empty texts have no signature.
    """
    w = Words(column, bare=True)
    h, row = w.hashes(), w.row_of()
    anchor = _ANCHORS[np.minimum(np.searchsorted(_ANCHORS, h), len(_ANCHORS) - 1)] == h
    place = np.arange(len(h))
    last = np.maximum.accumulate(np.where(anchor, place, w.rows[row] - 1)) if len(h) else place
    content, at = np.flatnonzero(~anchor), np.flatnonzero(anchor | (place - last > GAP))
    follow = np.searchsorted(content, at, "right")
    fits = follow + CHAIN <= len(content)
    at, follow = at[fits], follow[fits]
    fits = row[content[follow + CHAIN - 1]] == row[at]
    at, follow = at[fits], follow[fits]
    chain = h[at]
    for k in range(CHAIN):
        chain = (chain + h[content[follow + k]]) * U64(0xD6E8FEB86659FD93)
    chain = (mix(chain) >> U64(32)).astype(np.uint32)
    bounds = np.searchsorted(row[at], np.arange(len(w.rows)))
    single = (mix(h) >> U64(32)).astype(np.uint32)
    return [
        np.unique(chain[a:z] if a < z else single[i:j])
        for a, z, i, j in zip(bounds[:-1], bounds[1:], w.rows[:-1], w.rows[1:], strict=True)
    ]


def text_form(spots: np.ndarray) -> str:
    """A fingerprint as text: its signatures in ascending order, little-endian, in base 64."""
    return base64.b64encode(spots.astype("<u4").tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two fingerprints; 1 for two empty ones."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    same = len(np.intersect1d(a, b, assume_unique=True))
    return same / (len(a) + len(b) - same)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_spots, spots) of each row: spots are the sorted signatures as array<bigint>."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream):
            found = signatures(batch.column("text"))
            n = np.array([len(x) for x in found], np.int64)
            flat = np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)
            spots = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(flat))
            yield pa.record_batch([batch.column("doc_id"), pa.array(n), spots], names=["doc_id", "n_spots", "spots"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, n_spots bigint, spots array<bigint>")


def near_pairs(docs: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Near duplicates: (pairs, members).

    `members` has (doc_id, class_id) of every row; equal fingerprints are a class, named by its smallest doc_id. `pairs` has
    (a, b, similarity), a < b, of all classes whose Jaccard similarity reaches `threshold`. Classes without signatures pair
    with none. Rows with a NULL doc_id are left out of classes that have an id and form one with NULL otherwise.

    Fingerprints are partitioned by set length in steps of the threshold: similar ones lie in the same or the next
    partition. There they meet only on a shared signature among the first n - ceil(t n) + 1, and the bound by lengths and
    by the places of the shared signature prunes pairs before the whole sets are compared.
    """
    prints = cut(fingerprints(docs), "spots")
    classes = cut(prints.groupBy("spots").agg(F.min("doc_id").alias("class_id"), F.first("n_spots").alias("n")), "classes")
    members = prints.join(classes, "spots").select("doc_id", "class_id")
    step = -math.log(threshold)
    part = F.floor(F.log(F.col("n").cast("double")) / step + 1e-9)
    prefix = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1
    index = classes.where("n > 0 and class_id is not null").select("class_id", "n", part.alias("part"), F.posexplode(F.slice("spots", F.lit(1), prefix.cast("int"))).alias("place", "spot"))
    probe = index.select(F.col("class_id").alias("b"), F.col("n").alias("m"), F.explode(F.array("part", F.col("part") - 1)).alias("part"), F.col("place").alias("at"), "spot")
    own = index.withColumnRenamed("class_id", "a").withColumn("own", F.col("part"))
    most = F.least(F.col("n") - F.col("place"), F.col("m") - F.col("at"))
    met = (
        own.join(probe, ["part", "spot"])
        .where((F.col("a") != F.col("b")) & (F.least("n", "m") >= threshold * F.greatest("n", "m") - 1e-9))
        .where(most >= threshold / (1 + threshold) * (F.col("n") + F.col("m")) - 1e-9 - F.least("place", "at"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    sets = classes.select("class_id", "spots")
    both = met.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    same = F.size(F.array_intersect("x", "y"))
    pairs = both.select("a", "b", (same / (F.size("x") + F.size("y") - same)).alias("similarity")).where(F.col("similarity") >= threshold)
    return pairs, members


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprint of each row, of its edited text, and their likeness to each other and to the next row's.

    Rows are in descending order of doc_id (NULL last, equal ids in order of text); the first follows the last. The edited
    text is the text with its last floor(n_chars / 2) code points replaced by the first as many, or all, of the next.

    Rows are dealt once, by ranges of doc_id; each range also gets the first row of the range after it.
    """
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63)))
    keyed = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"), key.alias("key"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = keyed.agg(F.percentile_approx("key", [k / n for k in range(1, n)] or [0.5], 100 * n)).first()[0] or []
    bucket = F.lit(0) if not bounds else F.size(F.filter(F.array(*[F.lit(x) for x in sorted(set(bounds))]), lambda x: x >= F.col("key")))
    placed = keyed.withColumn("bucket", bucket)
    # One row for each range, of which there are no more than shuffle partitions.
    heads = sorted((r.bucket, r.head) for r in placed.groupBy("bucket").agg(F.max("key").alias("head")).collect())
    before = {head: heads[i - 1][0] for i, (_, head) in enumerate(heads)}
    own = F.struct(F.col("bucket"), F.lit(False).alias("guest"))
    if before:
        guest = F.create_map(*[F.lit(x) for kv in before.items() for x in kv])[F.col("key")]
        targets = F.when(guest.isNull(), F.array(own)).otherwise(F.array(own, F.struct(guest.alias("bucket"), F.lit(True).alias("guest"))))
    else:
        targets = F.array(own)
    dealt = placed.select("doc_id", "text", "key", F.explode(targets).alias("to")).select("doc_id", "text", "key", "to.*")
    ordered = dealt.repartitionById(max(1, len(set(bounds)) + 1), "bucket").sortWithinPartitions("bucket", "guest", F.desc("key"), "text")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches(stream):
            rows = held + list(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "guest", "bucket")), strict=True))
            follows = [i for i in range(len(rows) - 1) if not rows[i][2] and rows[i + 1][3] == rows[i][3]]
            held = rows[-1:]
            prints = signatures(pa.array([r[1] for r in rows], pa.large_string()))
            edited = [rows[i][1][: len(rows[i][1]) - len(rows[i][1]) // 2] + rows[i + 1][1][: len(rows[i][1]) // 2] for i in follows]
            changed = signatures(pa.array(edited, pa.large_string()))
            out = [
                (rows[i][0], len(rows[i][1]), hashlib.sha256(e.encode()).hexdigest(), text_form(prints[i]), text_form(c), likeness(prints[i], c), likeness(prints[i], prints[i + 1]))
                for i, e, c in zip(follows, edited, changed, strict=True)
            ]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.record_batch([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=names)

    return ordered.mapInArrow(run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
