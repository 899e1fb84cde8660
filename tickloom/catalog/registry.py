"""Registration of queries with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def comparable(df: DataFrame, digits: int) -> DataFrame:
    """Round doubles and show days and times as ISO text, so that two engines give equal values."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(c, digits)
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, doubles: str = "", dates: str = "", digits: int = 6):
    """Register a (spark, folder) function. `doubles` and `dates` name the SQL columns to round or show as text."""

    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(fn(spark, folder), digits)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            changed = [f"round({c}, {digits}) AS {c}" for c in doubles.split()]
            changed += [f"CAST({c} AS VARCHAR) AS {c}" for c in dates.split()]
            replace = f" REPLACE ({', '.join(changed)})" if changed else ""
            with_part, _, body = sql.strip().rpartition("-- result")
            ORACLE[name] = f"{with_part}\nSELECT *{replace} FROM ({body.strip()}) AS result"
        return fn

    return wrap
