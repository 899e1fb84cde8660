"""Ordered series cut into blocks, so that one long series is the work of many tasks.

A window over `partitionBy(tic)` gives a whole ticker to one task. Here rows are first counted per
(key, calendar bucket); the running count over that small table places every bucket in its series, and
each bucket is sent to the block it lies in and to the next block when that block needs it as history.
Windows then run over (key, block): equal answers, bounded groups, one shuffle for all indicators.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.session import cut

BLOCK_ROWS = 4096
BUCKET_ROWS = 1000
# Powers of a smoothing ratio are kept within 2**+-950; doubles end at 2**1023.
EXPONENT_BITS = 1900.0


@dataclass(frozen=True)
class Series:
    """Names the key and order columns, and a calendar unit holding at most `BUCKET_ROWS` rows of one key."""

    key: tuple[str, ...] = ("tic",)
    order: str = "date"
    bucket: str = "year"

    def bucket_column(self) -> Column:
        return F.date_trunc(self.bucket, F.col(self.order))


DAILY = Series()
HOURLY = Series(bucket="month")
MINUTE = Series(bucket="hour")


def _bucket_sizes(df: DataFrame, series: Series) -> DataFrame:
    keys = list(series.key)
    return df.groupBy(*keys, series.bucket_column().alias("_bucket")).agg(F.count(F.lit(1)).alias("_size"))


@dataclass
class Blocks:
    """A table whose rows carry `_block` and the 0-based place `_rn` in their series."""

    df: DataFrame
    series: Series
    capacity: int
    given: tuple[str, ...] = ()

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.series.key, "_block").orderBy(self.series.order)

    def running(self) -> WindowSpec:
        return self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def trailing(self, rows: int, end: int = 0) -> WindowSpec:
        """The last `rows` rows up to the current one, or up to `end` rows before it."""
        return self.window.rowsBetween(1 - rows + end, end)

    def finish(self) -> DataFrame:
        """Drop the copied history and the helper columns."""
        return self.df.filter("_own").select(*[c for c in self.df.columns if c in self.given or not c.startswith("_")])


def blocks(df: DataFrame, series: Series, history: int, block_rows: int = BLOCK_ROWS) -> Blocks:
    """Cut every series into blocks of about `block_rows`, each with at least `history` earlier rows."""
    keys = list(series.key)
    in_series = Window.partitionBy(*keys).orderBy("_bucket")
    placed = (
        _bucket_sizes(df, series)
        .withColumn(
            "_start",
            F.coalesce(F.sum("_size").over(in_series.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
        .withColumn("_last", F.max("_start").over(Window.partitionBy(*keys)))
        .select(
            *keys,
            "_bucket",
            "_start",
            F.floor(F.col("_start") / block_rows).alias("_home"),
            F.when(
                F.col("_size") <= BUCKET_ROWS,
                F.least(
                    F.floor((F.col("_start") + F.col("_size") + (history - 1)) / block_rows),
                    F.floor(F.col("_last") / block_rows),
                ),
            )
            .otherwise(F.raise_error(F.lit(f"a {series.bucket} of one key holds over {BUCKET_ROWS} rows")).cast("long"))
            .alias("_until"),
        )
    )
    spread = (
        df.withColumn("_bucket", series.bucket_column())
        .join(placed, [*keys, "_bucket"])
        .withColumn("_block", F.explode(F.sequence("_home", F.greatest("_home", "_until"))))
    )
    out = Blocks(spread, series, block_rows + history + BUCKET_ROWS, tuple(df.columns))
    out.df = spread.select(
        *df.columns,
        "_block",
        (F.col("_block") == F.col("_home")).alias("_own"),
        (F.row_number().over(out.window) - 1 + F.first("_start").over(out.running())).alias("_rn"),
    )
    return out


def trailing_sums(
    b: Blocks, values: dict[str, Column], lengths: dict[str, set[int]], end: int = 0, counted: bool = True
) -> None:
    """Sums and counts of the last n known values: columns `_sum_<name>_<n>` and `_cnt_<name>_<n>`.

    Without `counted` there are no counts, and a sum over a missing value is NaN.

    Spark re-adds a whole sliding frame for every row. Here sums of 2, 4, 8, ... rows are each built from two
    of the length before, and a length is put together from powers of two, so a row costs about log2(n)
    look-backs; nothing is ever subtracted, so nothing cancels. `end` shifts the window back (end <= 0).
    """
    kinds = {"z": "sum", "k": "cnt"} if counted else {"z": "sum"}
    missing = F.lit(0.0 if counted else float("nan"))
    add_level(b, {f"_z_{n}_1": F.coalesce(x.cast("double"), missing) for n, x in values.items()})
    if counted:
        add_level(b, {f"_k_{n}_1": x.isNotNull().cast("int") for n, x in values.items()})
    top = max(n for ns in lengths.values() for n in ns)
    power = 1
    while power * 2 <= top:
        level = {}
        for name, ns in lengths.items():
            if max(ns) >= power * 2:
                for p in kinds:
                    have = f"_{p}_{name}_{power}"
                    level[f"_{p}_{name}_{power * 2}"] = F.col(have) + F.lag(have, power, 0).over(b.window)
        add_level(b, level)
        power *= 2
    sums = {}
    for name, ns in lengths.items():
        for n in ns:
            for p, out in kinds.items():
                offset, total = -end, None
                for bit in range(n.bit_length()):
                    if n >> bit & 1:
                        have = f"_{p}_{name}_{1 << bit}"
                        part = F.lag(have, offset, 0).over(b.window) if offset else F.col(have)
                        total = part if total is None else total + part
                        offset += 1 << bit
                sums[f"_{out}_{name}_{n}"] = total
    add_level(b, sums)


def trailing_moments(b: Blocks, column: str, rows: int, end: int = 0) -> dict[str, Column]:
    """Count, mean and sample variance of the last `rows` rows, up to `end` rows before the current one.

    Differences of running sums, so the cost does not grow with `rows`. Values are taken about one of the
    block, so that a large level with little spread loses no digits, and a variance within rounding of the
    block's sum of squares counts as zero.
    """
    first = F.first(column, ignorenulls=True).over(b.window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    add_level(b, {"_near": first})
    off = F.col(column) - F.col("_near")
    add_level(b, {
        "_run_n": F.count(off).over(b.running()),
        "_run_s": F.coalesce(F.sum(off).over(b.running()), F.lit(0.0)),
        "_run_q": F.coalesce(F.sum(off * off).over(b.running()), F.lit(0.0)),
    })

    def between(name: str) -> Column:
        now = F.lag(name, -end, 0).over(b.window) if end else F.col(name)
        return now - F.lag(name, rows - end, 0).over(b.window)

    add_level(b, {f"_win_{m}": between(f"_run_{m}") for m in "nsq"})
    n, total, squares = F.col("_win_n"), F.col("_win_s"), F.col("_win_q")
    mean = F.try_divide(total, n)
    spread = squares - total * mean
    variance = F.when(spread > F.col("_run_q") * 1e-13, F.try_divide(spread, n - 1)).otherwise(F.lit(0.0))
    return {"count": n, "mean": F.col("_near") + mean, "variance": variance}


def add_level(b: Blocks, columns: dict[str, Column]) -> None:
    if columns:
        b.df = b.df.withColumns(columns)


def smooth(b: Blocks, values: dict[str, tuple[Column, float, int]], ratios: Iterable[tuple[str, ...]] = ()) -> None:
    """Exponential means, `name -> (value, alpha, rows needed)`, over whole series.

    With r = 1 - alpha and p the number of known values of a block so far, the mean is local + carry * r**p. `local` is
    r**p * sum(alpha * x_i * r**-p_i) over the block's own rows, with powers centred so that they stay within a double; a
    span too short for that is summed in smaller pieces. `carry` is the mean at the end of the blocks before. It follows
    from one row of every block, scanned per key, so no history is copied or cut.

    Of the means in one of `ratios` only the ratios matter: where all have been zero since the block began they are given
    up to a common factor, so that a long standstill doesn't let them run out of a double's range.
    """
    add_level(b, {f"_x_{n}": F.when(F.col("_own"), x.cast("double")) for n, (x, _, _) in values.items()})
    add_level(b, {f"_p_{n}": F.count(f"_x_{n}").over(b.running()) for n in values})
    local = {}
    for name, (_, alpha, _) in values.items():
        if alpha < 1.0 and b.capacity <= int(EXPONENT_BITS / -math.log2(1.0 - alpha)) - 1:
            power = F.exp((F.col(f"_p_{name}") - b.capacity // 2) * math.log(1.0 - alpha))
            local[f"_local_{name}"] = F.coalesce(F.sum(F.col(f"_x_{name}") * alpha / power).over(b.running()), F.lit(0.0)) * power
        else:
            _smooth_in_pieces(b, name, alpha)
    add_level(b, local)
    ratios = list(ratios)
    carried = cut(_carries(b, {n: 1.0 - alpha for n, (_, alpha, _) in values.items()}, ratios), "carries")
    b.df = b.df.join(carried, [*b.series.key, "_block"])
    results = {}
    for name, (_, alpha, needed) in values.items():
        seen = F.col(f"_p_{name}")
        decay = F.exp(seen * math.log(1.0 - alpha)) if alpha < 1.0 else F.when(seen == 0, 1.0).otherwise(0.0)
        mean = F.col(f"_local_{name}") + F.col(f"_carry_{name}") * decay
        for group in ratios:
            if name in group:
                still = [F.col(f"_local_{n}") == 0 for n in group]
                mean = F.when(functools.reduce(Column.__and__, still), F.col(f"_held_{name}")).otherwise(mean)
        results[name] = F.when(F.col(f"_before_{name}") + seen >= needed, mean)
    add_level(b, results)


def _smooth_in_pieces(b: Blocks, name: str, alpha: float) -> None:
    ratio = 1.0 - alpha
    if ratio <= 0.0:
        add_level(b, {f"_local_{name}": F.coalesce(F.last(f"_x_{name}", ignorenulls=True).over(b.running()), F.lit(0.0))})
        return
    piece = int(EXPONENT_BITS / 2 / -math.log2(ratio)) - 1
    place = F.greatest(F.col(f"_p_{name}") - 1, F.lit(0))
    add_level(b, {f"_q_{name}": F.floor(place / piece)})
    add_level(b, {f"_l_{name}": place - F.col(f"_q_{name}") * piece})
    power = F.exp((F.col(f"_l_{name}") - piece // 2) * math.log(ratio))
    in_piece = (
        Window.partitionBy(*b.series.key, "_block", f"_q_{name}")
        .orderBy(b.series.order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    add_level(b, {f"_e_{name}": F.coalesce(F.sum(F.col(f"_x_{name}") * alpha / power).over(in_piece), F.lit(0.0)) * power})
    ends = F.when(F.col(f"_l_{name}") == piece - 1, F.col(f"_e_{name}"))
    before = F.last(ends, ignorenulls=True).over(b.window.rowsBetween(Window.unboundedPreceding, -1))
    add_level(b, {f"_c_{name}": F.coalesce(before, F.lit(0.0))})
    decayed = F.col(f"_c_{name}") * F.exp((F.col(f"_l_{name}") + 1) * math.log(ratio))
    add_level(b, {f"_local_{name}": F.col(f"_e_{name}") + F.when(F.col(f"_q_{name}") > 0, decayed).otherwise(F.lit(0.0))})


def _carries(b: Blocks, decays: dict[str, float], ratios: list[tuple[str, ...]]) -> DataFrame:
    """What every block starts from: `_before_<name>` values, the mean `_carry_<name>`, and `_held_<name>` for `ratios`."""
    keys, ends = list(b.series.key), []
    for n in decays:
        known = F.when(F.col(f"_x_{n}").isNotNull(), F.col("_rn"))
        ends += [
            F.max(f"_p_{n}").alias(f"_n_{n}"),
            F.max_by(f"_local_{n}", "_rn").alias(f"_end_{n}"),
            F.min_by(f"_x_{n}", known).alias(f"_first_{n}"),
        ]
    rows = b.df.filter("_own").groupBy(*keys, "_block").agg(*ends)
    held = [n for group in ratios for n in group]

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_block")
        out, states = pdf[[*keys, "_block"]].copy(), {}
        for n, ratio in decays.items():
            states[n] = list(_states(pdf[f"_n_{n}"], pdf[f"_end_{n}"], pdf[f"_first_{n}"], ratio))
            out[f"_before_{n}"] = [before for _, _, before in states[n]]
            out[f"_carry_{n}"] = [math.ldexp(m, e) for m, e, _ in states[n]]
        for group in ratios:
            tops = [max((e for m, e, _ in row if m), default=0) for row in zip(*(states[n] for n in group), strict=True)]
            for n in group:
                out[f"_held_{n}"] = [math.ldexp(m, e - top) for (m, e, _), top in zip(states[n], tops, strict=True)]
        return out

    types = {f"_before_{n}": "bigint" for n in decays} | {f"_carry_{n}": "double" for n in decays} | {f"_held_{n}": "double" for n in held}
    schema = rows.select(*keys, "_block").withColumns({c: F.lit(None).cast(t) for c, t in types.items()}).schema
    return rows.groupBy(*keys).applyInPandas(scan, schema)


def _states(sizes: Iterable[int], ends: Iterable[float], firsts: Iterable[float], ratio: float) -> Iterator[tuple[float, int, int]]:
    """(mantissa, exponent, number of values) before each block. A series starts from its first value."""
    (m, e), seen = math.frexp(next((x for x in firsts if not math.isnan(x)), 0.0)), 0
    for n, end in zip(sizes, ends, strict=True):
        yield m, e, seen
        seen += n
        if n:
            bits = n * math.log2(ratio) if ratio > 0 else 0.0
            m, e = (m * 2.0 ** (bits - math.floor(bits)) if ratio > 0 else 0.0), e + math.floor(bits)
            x, f = math.frexp(end)
            top = max(e if m else f, f if x else e)
            m, up = math.frexp(math.ldexp(m, e - top) + math.ldexp(x, f - top))
            e = top + up


RUNNING_KINDS = ("sum", "max", "min", "last", "lag", "lead")


def running(df: DataFrame, series: Series, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Running sum, max, min, last known value, or the row before or after, over whole series: `name -> (kind, column)`.

    Each bucket is reduced to one row, the small bucket table is scanned per key, and what came before a
    bucket is joined to it; only then are a bucket's own rows scanned.
    """
    keys = list(series.key)
    order = F.col(series.order)
    reduce = {"sum": F.sum, "max": F.max, "min": F.min}
    partials, before = [], []
    w = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    for name, (kind, column) in columns.items():
        if kind not in RUNNING_KINDS:
            raise ValueError(f"unknown running kind {kind!r}")
        if kind == "last":
            c = F.col(column)
            partials.append(F.max_by(c, F.when(c.isNotNull(), order)).alias(f"_t_{name}"))
            before.append(F.last(f"_t_{name}", ignorenulls=True).over(w).alias(f"_b_{name}"))
        elif kind == "lag":
            partials.append(F.max_by(F.col(column), order).alias(f"_t_{name}"))
            before.append(F.last(f"_t_{name}").over(w).alias(f"_b_{name}"))
        elif kind == "lead":
            partials.append(F.min_by(F.struct(F.col(column).alias("v")), order).alias(f"_t_{name}"))
            before.append(F.lead(f"_t_{name}").over(Window.partitionBy(*keys).orderBy("_bucket")).alias(f"_b_{name}"))
        else:
            partials.append(reduce[kind](column).alias(f"_t_{name}"))
            before.append(reduce[kind](f"_t_{name}").over(w).alias(f"_b_{name}"))
    totals = df.groupBy(*keys, series.bucket_column().alias("_bucket")).agg(*partials)
    prior = totals.select(*keys, "_bucket", *before)
    inside = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy(series.order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = df.withColumn("_bucket", series.bucket_column()).join(prior, [*keys, "_bucket"])
    results = {}
    for name, (kind, column) in columns.items():
        prev = F.col(f"_b_{name}")
        if kind == "last":
            results[name] = F.coalesce(F.last(column, ignorenulls=True).over(inside), prev)
        elif kind == "lag":
            in_bucket = Window.partitionBy(*keys, "_bucket").orderBy(series.order)
            results[name] = F.when(F.row_number().over(in_bucket) == 1, prev).otherwise(F.lag(column).over(in_bucket))
        elif kind == "lead":
            in_bucket = Window.partitionBy(*keys, "_bucket").orderBy(series.order)
            results[name] = F.coalesce(F.lead(F.struct(F.col(column).alias("v"))).over(in_bucket), prev)["v"]
        elif kind == "sum":
            here = F.sum(column).over(inside)
            results[name] = F.coalesce(here + prev, here, prev)
        else:
            here = reduce[kind](column).over(inside)
            results[name] = (F.greatest if kind == "max" else F.least)(here, prev)
    out = out.withColumns(results)
    return out.select(*[c for c in df.columns if c not in results], *results)


def shifted(df: DataFrame, series: Series, columns: dict[str, tuple[str, int]]) -> DataFrame:
    """Earlier values of a series: `name -> (column, rows back)`."""
    b = blocks(df, series, max(rows for _, rows in columns.values()))
    add_level(b, {n: F.lag(c, rows).over(b.window) for n, (c, rows) in columns.items()})
    return b.finish()
