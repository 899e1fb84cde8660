"""Writers. Every writer is one distributed job; none brings rows to the driver."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.text import sanitize_ticker
from tickloom.session import cut, scratch_path
from tickloom.sources.runs import observed_write


def sink_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV with a header line in every file."""
    df.write.mode(mode).option("header", True).csv(path)
    return path


def sink_parquet_if_nonempty(df: DataFrame, path: str, mode: str = "overwrite") -> bool:
    """Write unless there is nothing to write; tells whether it did. What lies at `path` stays if there is nothing.

    The plan runs once: its rows are counted while they are staged in the shared scratch folder, and the staged files are
    copied or forgotten. A table of runs (`runs.publish_run`) needs no copy.
    """
    staged = scratch_path(df.sparkSession, "staged")
    if not observed_write(df, staged):
        return False
    df.sparkSession.read.schema(df.schema).parquet(staged).write.mode(mode).parquet(path)
    return True


def sink_with_schema(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Parquet that carries the schema even when there are no rows."""
    df.write.mode(mode).parquet(path)
    return path


def sink_csv_with_header(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV whose header is written even when there are no rows. The plan runs once; without rows a second, empty write adds the header."""
    if not observed_write(df, path, mode, "csv", header=True) and mode != "append":
        df.sparkSession.createDataFrame([], df.schema).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def sink_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path


def sink_by_date(df: DataFrame, path: str, by_ticker: bool = False, mode: str = "overwrite") -> str:
    """Table laid out by day, and by cleaned ticker if wanted.

    The rebalance hint gathers the rows of a folder into files of the advised size and splits a busy day or
    ticker over several tasks.
    """
    keys = ["date", "tic"] if by_ticker else ["date"]
    out = df.withColumn("tic", sanitize_ticker("tic")) if by_ticker else df
    out.hint("rebalance", *keys).write.mode(mode).partitionBy(*keys).parquet(path)
    return path


def sink_run_stamped(df: DataFrame, path: str, run_ts: str) -> str:
    """Append a run to a table laid out by run stamp (yyyyMMdd_HHmmss)."""
    df.withColumn("run_ts", F.lit(run_ts)).write.mode("append").partitionBy("run_ts").parquet(path)
    return path


def sink_outputs(source: DataFrame, outputs: Mapping[str, tuple[str, Column | None, list[str]]]) -> dict[str, int]:
    """Several outputs of one expensive plan: `name -> (path, filter, columns)`. Returns the rows of each, counted while written.

    The plan is written once to the shared scratch folder and every output reads that, so it runs once and
    survives lost executors.
    """
    base = cut(source, "outputs")
    written = {}
    for name, (path, condition, columns) in outputs.items():
        part = base if condition is None else base.filter(condition)
        written[name] = observed_write(part.select(*columns), path)
    return written
