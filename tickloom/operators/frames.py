"""Projection, filtering, ordering, set and split steps."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.schemas import ALIASES, OHLCV


# --- columns -----------------------------------------------------------------------------------------------
def canon_columns(df: DataFrame, aliases: Mapping[str, str] = ALIASES) -> DataFrame:
    """Canonical lower-case names. An alias gives way to a canonical column that is already there."""
    low = df.toDF(*[c.lower() for c in df.columns])
    renames = {a: c for a, c in aliases.items() if a in low.columns and c not in low.columns}
    out = low.withColumnsRenamed(renames)
    if "close" not in out.columns and "adj_close" in out.columns:
        out = out.withColumnRenamed("adj_close", "close")
    return out


def date_timestamp_swap(df: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run a step that wants `timestamp` on a table that has `date`, and name it back."""
    if "timestamp" in df.columns or "date" not in df.columns:
        return step(df)
    out = step(df.withColumnRenamed("date", "timestamp"))
    return out.withColumnRenamed("timestamp", "date") if "date" not in out.columns else out


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def add_missing_null_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of `schema`, in its order; absent ones are NULL."""
    have = set(df.columns)
    return df.select(
        *[F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    )


def available_features(df: DataFrame, wanted: Sequence[str], keys: Sequence[str] = ("date", "tic")) -> DataFrame:
    """The configured features that are there, in configured order, after the key columns."""
    return df.select(*keys, *[c for c in wanted if c in df.columns and c not in keys])


def fill_missing_features(df: DataFrame, wanted: Sequence[str], value: float = 0.0) -> DataFrame:
    return df.withColumns({c: F.lit(value) for c in missing_columns(df, wanted)})


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*numeric_columns(df))


# The columns preferred in a correlation table.
SENTIMENT_FEATURES = (
    "sentiment_positive_prob", "sentiment_negative_prob", "sentiment_neutral_prob", "sentiment_composite_score",
    "sentiment_label", "sentiment_composite_score_lag1", "sentiment_label_lag1", "sentiment_composite_score_ma3",
)
PRICE_FEATURES = (*OHLCV, "macd", "rsi_30")


def pick_columns(numeric: Sequence[str], preferred: Sequence[str] = (*SENTIMENT_FEATURES, *PRICE_FEATURES), limit: int = 15) -> list[str]:
    """At most `limit` columns: all if so few, else the preferred ones in their order, else the first ones."""
    few = len(numeric) <= limit
    known = list(numeric) if few else sorted(set(numeric) & set(preferred), key=list(preferred).index)
    return (known or list(numeric))[:limit]


def step_if(enabled: bool, df: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A configured step, or the table as it is. Decided while planning."""
    return step(df) if enabled else df


# --- checks ------------------------------------------------------------------------------------------------
def all_null_check(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row telling for each column whether it is absent or entirely NULL."""
    return df.agg(
        *[
            (F.count(c) == 0).alias(c) if c in df.columns else F.first(F.lit(True)).alias(c)
            for c in columns
        ]
    )


def validate_schema(df: DataFrame, types: Mapping[str, str], ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """One row of violations: columns missing or of another type, and the rows outside each range."""
    have = dict(df.dtypes)
    wrong = sum(1 for c, t in types.items() if have.get(c) != t)
    outside = [
        F.count_if(~F.col(c).between(lo, hi)).alias(f"{c}_out_of_range") for c, (lo, hi) in ranges.items() if c in have
    ]
    return df.agg(F.first(F.lit(wrong)).cast("long").alias("schema_errors"), *outside)


def choose_text_column(df: DataFrame, first: str, second: str, name: str = "text") -> DataFrame:
    """`first` if it has any value in the whole table, else `second`; one small aggregate decides."""
    if first not in df.columns:
        return df.withColumn(name, F.col(second))
    filled = df.agg((F.count(first) > 0).alias("f")).scalar()
    return df.withColumn(name, F.when(filled, F.col(first)).otherwise(F.col(second)))


def parse_date_like(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Timestamps when every value can be read as one, otherwise NULL timestamps beside the kept text."""
    name = name or f"{column}_parsed"
    parsed = F.col(column).try_cast("timestamp_ntz")
    readable = df.agg((F.count(column) == F.count(parsed)).alias("ok")).scalar()
    return df.withColumn(name, F.when(readable, parsed))


# --- filters -----------------------------------------------------------------------------------------------
def drop_null_critical(df: DataFrame, columns: Sequence[str] = ("published_at", "headline")) -> DataFrame:
    return df.dropna("any", subset=list(columns))


def drop_all_null(df: DataFrame, columns: Sequence[str] = OHLCV) -> DataFrame:
    return df.dropna("all", subset=list(columns))


def half_open(df: DataFrame, start: Column | str, end: Column | str, column: str = "date") -> DataFrame:
    """start <= column < end; compares the bare column, so the filter reaches the scan."""
    return df.filter((F.col(column) >= start) & (F.col(column) < end))


def closed_days(df: DataFrame, first: str, last: str, column: str = "published_at", kind: str = "timestamp_ntz") -> DataFrame:
    """From the start of `first` through the end of `last`."""
    start = F.lit(first).cast(kind)
    after = (F.lit(last).cast(kind) + F.expr("INTERVAL 1 DAY")).cast(kind)
    return half_open(df, start, after, column)


def lookback(df: DataFrame, as_of: str, days: int, column: str = "date") -> DataFrame:
    """The `days` days before `as_of`, that day included."""
    end = F.lit(as_of).cast("date")
    return df.filter((F.col(column) >= F.date_sub(end, days)) & (F.col(column) <= end))


# --- order -------------------------------------------------------------------------------------------------
def newest_per_query(news: DataFrame, query: str = "source_name", limit: int = 100,
                     order: Sequence[Column] | None = None) -> DataFrame:
    """The `limit` newest articles of each query. Spark keeps at most `limit` rows per query before the shuffle."""
    order = order or [F.desc("published_at"), F.asc("id")]
    w = Window.partitionBy(query).orderBy(*order)
    return news.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)


def head(df: DataFrame, rows: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(rows)


# --- set operations and splits -----------------------------------------------------------------------------
def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def ticker_universe(a: DataFrame, b: DataFrame, key: str = "tic") -> DataFrame:
    """Distinct tickers of both lists. Each side is made distinct before they meet."""
    return a.select(key).distinct().union(b.select(key).distinct()).distinct()


def column_sets(a: DataFrame, b: DataFrame) -> dict[str, list[str]]:
    return {
        "common": [c for c in a.columns if c in b.columns],
        "only_left": [c for c in a.columns if c not in b.columns],
        "only_right": [c for c in b.columns if c not in a.columns],
    }


def split_column(share: float, seed: int, *keys: Column | str) -> Column:
    """`validation` for about `share` of the keys, else `train`.

    Depends on the key and the seed only, so it is the same after any repartitioning or retry, which
    `randomSplit` is not.
    """
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k) if isinstance(k, str) else k for k in keys])
    place = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return F.when(place < int(share * 2**32), F.lit("validation")).otherwise(F.lit("train"))


def train_validation_split(df: DataFrame, share: float, seed: int, *keys: str) -> tuple[DataFrame, DataFrame]:
    marked = df.withColumn("_split", split_column(share, seed, *keys))
    return (
        marked.filter("_split = 'train'").drop("_split"),
        marked.filter("_split = 'validation'").drop("_split"),
    )


def date_split(df: DataFrame, train: tuple[str, str], trade: tuple[str, str]) -> DataFrame:
    """Rows of two half-open ranges, each marked with the set it belongs to."""
    d = F.col("date")

    def within(r: tuple[str, str]) -> Column:
        return (d >= F.lit(r[0]).cast("date")) & (d < F.lit(r[1]).cast("date"))

    sets = F.array_compact(
        F.array(F.when(within(train), F.lit("train")), F.when(within(trade), F.lit("trade")))
    )
    lo, hi = min(train[0], trade[0]), max(train[1], trade[1])
    return half_open(df, F.lit(lo).cast("date"), F.lit(hi).cast("date")).withColumn("part", F.explode(sets))


def walk_forward_folds(df: DataFrame, start: str, folds: int, train_days: int, test_days: int, step: int) -> DataFrame:
    """Rows with the fold and the side they serve in.

    The folds of a row follow from its day by arithmetic, so rows are expanded in place: no join with a
    fold table and no shuffle.
    """
    day = F.datediff("date", F.lit(start).cast("date"))

    def fold_range(first_day: int, length: int) -> Column:
        # fold f covers first_day + f*step <= day < first_day + f*step + length
        lo = F.greatest(F.ceil((day - first_day - length + 1) / step), F.lit(0))
        hi = F.least(F.floor((day - first_day) / step), F.lit(folds - 1))
        return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))

    roles = F.concat(
        F.transform(fold_range(0, train_days), lambda f: F.struct(f.alias("fold"), F.lit("train").alias("part"))),
        F.transform(fold_range(train_days, test_days), lambda f: F.struct(f.alias("fold"), F.lit("test").alias("part"))),
    )
    return df.withColumn("_role", F.explode(roles)).select(*df.columns, "_role.fold", "_role.part")
