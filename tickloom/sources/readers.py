"""Readers with stated schemas. Nothing is inferred, so no file is read twice and types do not depend on the data."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def scan_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, keep_corrupt: bool = False) -> DataFrame:
    """CSV files with a header. A line that does not fit gives NULLs, and its text if `keep_corrupt`."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]) if keep_corrupt else schema
    return (
        spark.read.schema(full).option("header", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    )


def scan_parquet(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    return (spark.read.schema(schema) if schema else spark.read).parquet(*paths)


def scan_json_array(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Files that hold a JSON list (a row per element) or one object (one row)."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def scan_jsonl(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def scan_text_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Every file is one document; files of white space only are left out."""
    docs = spark.read.text(path, wholetext=True)
    named = docs.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return named.filter(F.regexp_replace("text", r"(?U)\s+", "") != "")


def scan_date_partition(spark: SparkSession, path: str, day: str, schema: T.StructType | None = None) -> DataFrame:
    """One day of a table laid out by `date`: only that day's folder is listed in the scan."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path).filter(F.col("date") == F.lit(day).cast("date"))


def scan_latest_run(spark: SparkSession, path: str, column: str = "run_ts") -> DataFrame:
    """The newest run of a table laid out by run stamp. The stamp is found first and prunes the scan."""
    table = spark.read.parquet(path)
    return table.filter(F.col(column) == table.agg(F.max(column).alias("m")).scalar())


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def scan_presplit(
    spark: SparkSession,
    base: str,
    schema: T.StructType,
    split: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
    fmt: str = "json",
) -> tuple[DataFrame, DataFrame]:
    """Train and test from their folders if both are there, else one table split by `split`."""
    def read(path: str) -> DataFrame:
        return scan_csv(spark, path, schema) if fmt == "csv" else scan_jsonl(spark, path, schema)

    if path_exists(spark, f"{base}/train") and path_exists(spark, f"{base}/test"):
        return read(f"{base}/train"), read(f"{base}/test")
    return split(read(base))


def read_sources(spark: SparkSession, sources: Sequence[Mapping]) -> tuple[DataFrame | None, DataFrame]:
    """The union of the enabled sources, `{"name", "enabled", "read"}` each, and (source, reason) of those left out.

    The union has a column `source_table` with the name; columns may differ between sources. Left out are disabled sources
    ('disabled') and those that Spark cannot plan, such as a missing path or column (the condition it names); any other
    error is raised. The union is None when no source is left.
    """
    frames, left_out = [], []
    for source in sources:
        if not source.get("enabled", True):
            left_out.append((source["name"], "disabled"))
            continue
        try:
            frames.append(source["read"]().withColumn("source_table", F.lit(source["name"])))
        except AnalysisException as error:
            left_out.append((source["name"], error.getCondition() or str(error).splitlines()[0]))
    reasons = spark.createDataFrame(left_out, "source string, reason string")
    return (reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None), reasons


def scan_sources(spark: SparkSession, sources: Sequence[Mapping], sort: Sequence[str | Column] = (), allowed: Sequence[str] = ()) -> DataFrame:
    """Union of the enabled sources. Raises when one that isn't `allowed` to be absent cannot be planned, or none is left."""
    both, reasons = read_sources(spark, sources)
    absent = [r for r in reasons.collect() if r.reason != "disabled" and r.source not in allowed]
    if absent:
        raise ValueError("sources that cannot be read: " + ", ".join(f"{r.source} ({r.reason})" for r in absent))
    if both is None:
        raise ValueError("no source could be read")
    both = both.drop("source_table")
    return both.orderBy(*sort) if sort else both


def fallback_source(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """The secondary source only where the primary has no rows, decided inside the plan."""
    return primary.unionByName(secondary.filter(~primary.exists()))
