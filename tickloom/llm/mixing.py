"""Mixing sources to target weights by Poisson replication, in DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.session import cut

PART = 16.0  # a larger rate is the sum of parts of at most this rate, so that exp(-rate) stays far from 0
BROADCAST_SOURCES = 10_000  # a table of rates with more rows is joined without a broadcast hint


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5, epochs: float = 1.0) -> DataFrame:
    """(source, size, rate): how often a document of each source is repeated on average.

    A source's size is its code points plus one a document. Its share of the output is its weight over the sum of weights:
    the given `weights` (sources not named get 0), or size to the power `temperature`. The output is about `epochs` times
    the size of the input.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.char_length(F.coalesce("text", F.lit(""))) + F.lit(1).cast("bigint")).alias("size"))
    if weights is None:
        weight = F.pow(F.col("size").cast("double"), F.lit(temperature))
    else:
        named = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]) if weights else F.create_map().cast("map<string,double>")
        weight = F.coalesce(named[F.col("source")].cast("double"), F.lit(0.0))
    weighted = sizes.withColumn("weight", weight)
    total = weighted.agg(F.sum("size").cast("double").alias("size"), F.sum("weight").alias("weight"))
    # One row, so scalar subqueries and no join.
    total.createOrReplaceTempView("_mixing_total")
    weighted.createOrReplaceTempView("_mixing_sizes")
    return docs.sparkSession.sql(
        f"""SELECT source, size, coalesce(weight / nullif((SELECT weight FROM _mixing_total), 0D)
            * (SELECT size FROM _mixing_total) * {float(epochs)}D / size, 0D) AS rate FROM _mixing_sizes"""
    )


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))


def _invert(u: Column, mean: Column) -> Column:
    """The smallest k with u < P(X <= k) for X of a Poisson distribution."""
    p0 = F.exp(-mean)
    state = F.struct(F.lit(0).alias("k"), p0.alias("p"), p0.alias("c"))

    def step(s: Column, j: Column) -> Column:
        p = s["p"] * mean / j
        return F.when(u >= s["c"], F.struct(j.alias("k"), p.alias("p"), (s["c"] + p).alias("c"))).otherwise(s)

    last = F.ceil(mean + 10 * F.sqrt(mean) + 20).cast("int")
    return F.aggregate(F.sequence(F.lit(1), last), state, step, lambda s: s["k"])


def copies(seed: str, key: Column, rate: Column) -> Column:
    """A Poisson number with mean `rate`, always the same for a seed and key."""
    parts = F.ceil(rate / PART).cast("int")
    mean = rate / parts
    total = F.aggregate(
        F.sequence(F.lit(1), F.greatest(parts, F.lit(1))),
        F.lit(0),
        lambda acc, i: acc + _invert(_uniform(F.lit(seed), key, i.cast("string")), mean),
    )
    return F.when(rate > 0, total).otherwise(0)


def mix_sources(
    docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5, epochs: float = 1.0, seed: str = "mix"
) -> DataFrame:
    """Each row of `docs` repeated a Poisson number of times, in a global random order, with mix_copy (from 1) and mix_key.

    The number comes from an MD5 of the seed and doc_id (of the text, where doc_id is NULL), so it does not change with
    partitions, and repeated rows repeat alike. Rates are those of source_rates(); rows of a NULL source are a source of
    their own. A NULL or empty text is one code point long. Columns named mix_copy or mix_key are replaced. An empty table
    and weights that are all 0 give no rows.

    mix_key is a second MD5: rows are dealt to partitions by it and sorted by it there. That is the only shuffle of texts.
    """
    rates = cut(source_rates(docs.select("source", "text"), weights, temperature, epochs), "rates")
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    own = [c for c in docs.columns if c.lower() not in ("mix_copy", "mix_key")]
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("doc"), key.alias("key"), F.col("source").alias("of"))
    joined = keyed.join(rates, F.col("of").eqNullSafe(F.col("source")))
    counted = joined.select("doc", "key", copies(seed, F.col("key"), F.col("rate")).alias("n")).where("n > 0")
    out = counted.select("doc", "key", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("mix_copy"))
    out = out.select("doc.*", "mix_copy", F.md5(F.concat_ws("|", F.lit(f"{seed}-order"), F.col("key"), F.col("mix_copy").cast("string"))).alias("mix_key"))
    return out.repartition("mix_key").sortWithinPartitions("mix_key")


#: mix_sources(documents) with its defaults, for DuckDB.
SQL = """
WITH RECURSIVE sizes AS (SELECT source, sum(length(coalesce(text, '')) + 1) AS size FROM documents GROUP BY source),
rates AS (
  SELECT source, pow(size::DOUBLE, 0.5) / sum(pow(size::DOUBLE, 0.5)) OVER () * (sum(size) OVER ())::DOUBLE * 1.0 / size AS rate
  FROM sizes),
parts AS (SELECT source, ceil(rate / 16.0)::INT AS parts, rate / ceil(rate / 16.0)::INT AS mean FROM rates WHERE rate > 0),
cdf AS (
  SELECT source, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS c FROM parts
  UNION ALL
  SELECT source, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM cdf WHERE k + 1 < ceil(mean + 10 * sqrt(mean) + 20)),
keyed AS (SELECT *, coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS key, row_number() OVER () AS r FROM documents),
draws AS (
  SELECT r, d.source, d.key, i, ('0x' || substr(md5('mix|' || d.key || '|' || i), 1, 13))::BIGINT::DOUBLE / 4503599627370496 AS u
  FROM (SELECT r, source, key FROM keyed) d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source, unnest(range(1, p.parts + 1)) AS t(i)),
counts AS (
  SELECT r, count(*) AS n FROM draws JOIN cdf ON draws.source IS NOT DISTINCT FROM cdf.source AND draws.u >= cdf.c GROUP BY r)
SELECT doc_id, text, lang, source, n_chars, copy::INT AS mix_copy, md5('mix-order|' || key || '|' || copy) AS mix_key
FROM keyed JOIN counts USING (r), unnest(range(1, n + 1)) AS t(copy)
"""
