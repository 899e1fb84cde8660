"""Keyword lists of any length: keywords meet the stretches of words of each text that have their shape."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.text import WORD_CLASS
from tickloom.bitmaps import BITS, bitmap, marked

_PIECE = rf"({WORD_CLASS}+|[^{WORD_CLASS[1:]}+)"


def _pieces(text: Column) -> Column:
    """The words of a text and what stands between, before and after them, in the order of the text."""
    return F.regexp_extract_all(text, F.lit(_PIECE), F.lit(1))


def _begins_with_word(text: Column) -> Column:
    return text.rlike(f"^{WORD_CLASS}")


def _place(keyword: Column) -> Column:
    return F.pmod(F.xxhash64(keyword), F.lit(BITS))


def keyword_index(keywords: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keyword, gap, n, keys) of a table (keyword, keys): its number of pieces, and 1 if the first one is no word, 0 if it is.

    Keywords are lowered; empty ones are left out and repeated ones are one.
    """
    lowered = keywords.select(F.lower("keyword").alias("keyword"), *keys).where("keyword <> ''").distinct()
    gap = F.when(_begins_with_word(F.col("keyword")), 0).otherwise(1)
    return lowered.select("keyword", gap.alias("gap"), F.size(_pieces(F.col("keyword"))).alias("n"), *keys)


def _stretches(text: Column, shapes: Sequence[tuple[int, int]]) -> Column:
    """The different stretches of pieces of the given shapes (gap, n) that lie between the first and the last word of a text."""

    def of(found: Column) -> Column:
        before, after = (F.when(_begins_with_word(x), 0).otherwise(1) for x in (found[0], F.element_at(found, -1)))
        inner = F.when(F.size(found) > before + after, F.slice(found, before + 1, F.size(found) - before - after)).otherwise(F.array().cast("array<string>"))
        return F.transform(F.array(inner), cut)[0]

    def cut(inner: Column) -> Column:
        every = [F.when(F.size(inner) >= gap + n, F.transform(F.sequence(F.lit(gap + 1), F.size(inner) - (n - 1), F.lit(2)), stretch(inner, n))) for gap, n in shapes]
        return F.array_distinct(F.concat(*[F.coalesce(x, F.array().cast("array<string>")) for x in every]))

    def stretch(inner: Column, n: int):
        return lambda at: F.array_join(F.slice(inner, at, n), "")

    return F.transform(F.array(_pieces(text)), lambda found: F.when(F.size(found) > 0, of(found)))[0]


def keyword_counts(df: DataFrame, key: str, text: str, keywords: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(key, keys, hits): how many different keywords of each list occur in each text, for texts with any.

    `keywords` has a keyword and the `keys` of the list it is on. The same as `keyword_hits`: a keyword that keeps the bounds of
    words is a stretch of whole words and of whole gaps between them, so it is met by equality. The cost goes with the words
    of the texts for each different shape of keyword, not with the number of keywords. No text travels, only the
    stretches that a bitmap of the keywords doesn't rule out.
    """
    index = keyword_index(keywords, keys)
    shapes = [tuple(r) for r in index.select("gap", "n").distinct().orderBy("gap", "n").collect()]  # a few, however many keywords
    if not shapes:
        return df.select(key).crossJoin(index.select(*keys)).withColumn("hits", F.lit(0).cast("bigint")).limit(0)
    bits = bitmap(index.select(_place(F.col("keyword")).alias("place")))

    def met(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            yield batch.filter(pa.array(marked(bits, batch.column("_place").to_numpy()), pa.bool_()))

    lowered = df.select(F.col(key).alias("_key"), F.lower(text).alias("_text")).where("_text is not null")
    stretches = lowered.select("_key", F.explode(_stretches(F.col("_text"), shapes)).alias("keyword"))
    placed = stretches.withColumn("_place", _place(F.col("keyword")))
    found = placed.mapInArrow(met, placed.schema).select("_key", "keyword").join(index.select("keyword", *keys), "keyword")
    return found.groupBy(F.col("_key").alias(key), *keys).agg(F.count(F.lit(1)).alias("hits"))
