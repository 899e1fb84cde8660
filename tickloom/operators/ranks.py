"""Places in a global order without a global sort in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import cut


def ordered_prefix(counts: DataFrame, group: str, value: str, measures: Sequence[str]) -> DataFrame:
    """For every (group, value) row the sums of `measures` over the smaller values, as `before_<measure>`, and over
    the whole group, as `total_<measure>`.

    `counts` holds one row per (group, value). It is range-partitioned by Spark, written once, and its
    partitions' totals are scanned; each task then adds up its own range. The written table fixes the
    ranges, so a lost executor cannot change them.
    """
    ranged = cut(
        counts.repartitionByRange(F.col(group), F.col(value))
        .withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(group)
    starts = (
        ranged.groupBy(group, "_range").agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
        .select(
            group, "_range",
            *[F.coalesce(F.sum(f"_t_{m}").over(before), F.lit(0)).alias(f"_s_{m}") for m in measures],
            *[F.sum(f"_t_{m}").over(whole).alias(f"total_{m}") for m in measures],
        )
    )
    inside = Window.partitionBy(group, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.join(starts, [group, "_range"])
    return out.withColumns(
        {f"before_{m}": F.coalesce(F.sum(m).over(inside), F.lit(0)) + F.col(f"_s_{m}") for m in measures}
    ).drop("_range", *[f"_s_{m}" for m in measures])


def exact_quantiles(values: DataFrame, group: str, value: str, probs: Sequence[float]) -> DataFrame:
    """Quantiles with linear interpolation, one row per group, columns `q0`, `q1`, ... in the order of `probs`.

    Equal values are counted first, so a value that fills a third of the table is one row afterwards.
    """
    counts = values.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    ranked = ordered_prefix(counts, group, value, ["n"])
    picks = []
    for i, p in enumerate(probs):
        place = (F.col("total_n") - 1) * p
        for name, at in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            here = (F.col("before_n") <= at) & (at < F.col("before_n") + F.col("n"))
            picks.append(F.max(F.when(here, F.col(value))).alias(f"_{name}{i}"))
    found = ranked.groupBy(group, "total_n").agg(*picks)
    out = []
    for i, p in enumerate(probs):
        place = (F.col("total_n") - 1) * p
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        out.append((lo + (hi - lo) * (place - F.floor(place))).alias(f"q{i}"))
    return found.select(group, *out)
