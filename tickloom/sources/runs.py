"""Tables of runs: what a run wrote counts from the moment a small list names it.

`path/rows` holds a folder for each write, `path/list` a row for each finished one. Nothing is overwritten, so a write that
breaks off leaves a folder that no reader looks at, and the newest run is found without listing or reading rows.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIST = "run string, attempt bigint, part string, n_rows bigint, fields string"


def observed_write(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet", **options) -> int:
    """Write `df` and return its number of rows, counted by the tasks that write them: one run of the plan.

    The count is taken right under the writer, where a task that is run again counts once.
    """
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n_rows")).write.mode(mode).format(fmt).options(**options).save(path)
    return seen.get.get("n_rows") or 0


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The list as it is; no rows where nothing was published yet."""
    try:
        return spark.read.schema(LIST).parquet(f"{path}/list")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LIST)


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """One row for each (run, attempt): of two writers of the same attempt the smaller folder name counts."""
    return _lines(spark, path).groupBy("run", "attempt").agg(
        F.min("part").alias("part"), F.min_by("n_rows", "part").alias("n_rows"), F.min_by("fields", "part").alias("fields"))


def list_runs(spark: SparkSession, path: str) -> DataFrame:
    """(run, attempt, n_rows) of the finished writes."""
    return _listed(spark, path).select("run", "attempt", "n_rows")


def publish_run(df: DataFrame, path: str, run: str, attempt: int = 0, skip_empty: bool = False) -> int:
    """Add the rows of one attempt of a run, once: an attempt that is listed already is not written again.

    Returns its rows. With `skip_empty` a run without rows is not listed. Rows are counted while they are written.
    """
    spark = df.sparkSession
    same = (F.col("run") == run) & (F.col("attempt") == attempt)
    there = _lines(spark, path).where(same).agg(F.min_by("n_rows", "part").alias("n_rows")).first()
    if there.n_rows is not None:
        return there.n_rows
    part = uuid.uuid4().hex
    n_rows = observed_write(df, f"{path}/rows/part={part}")
    if n_rows or not skip_empty:
        line = (run, attempt, part, n_rows, json.dumps(df.schema.jsonValue()))
        spark.createDataFrame([line], LIST).coalesce(1).write.mode("append").parquet(f"{path}/list")
    return n_rows


def _fields(text: str) -> T.StructType:
    fields = T.StructType.fromJson(json.loads(text)).fields
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields])


def scan_newest_run(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the newest finished run (greatest name, then attempt). One folder is listed and read. Raises if there is none."""
    newest = _listed(spark, path).orderBy(F.desc("run"), F.desc("attempt")).first()
    if newest is None:
        raise ValueError(f"no finished run under {path}")
    return spark.read.schema(_fields(newest.fields)).parquet(f"{path}/rows/part={newest.part}")


def scan_runs(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all finished writes with their `run` and `attempt`, in the columns of the newest; folders that are not listed are pruned."""
    listed = _listed(spark, path)
    newest = listed.orderBy(F.desc("run"), F.desc("attempt")).first()
    if newest is None:
        raise ValueError(f"no finished run under {path}")
    own = [f for f in _fields(newest.fields) if f.name not in ("run", "attempt", "part")]
    schema = T.StructType([*own, T.StructField("part", T.StringType())])
    parts = listed.agg(F.collect_set("part").alias("parts")).scalar()  # one name for each run; prunes folders
    rows = spark.read.schema(schema).parquet(f"{path}/rows").where(F.array_contains(parts, F.col("part")))
    return rows.join(listed.select("run", "attempt", "part"), "part").drop("part")
