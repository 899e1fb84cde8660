"""Session settings and the shared scratch folder used for durable intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


LOCAL_SCRATCH = "/tmp/tickloom-scratch"


def build_session(cores: str = "8", app: str = "tickloom", shuffle_partitions: int | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster the submitter's session is used as it is."""
    parts = shuffle_partitions or (int(cores) if cores.isdigit() else 8)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", f"file://{LOCAL_SCRATCH}")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder shared by the driver and all executors: spark.checkpoint.dir, or a folder in the warehouse where that is unset."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch").rstrip("/")


def scratch_path(spark: SparkSession, stem: str) -> str:
    """A fresh path under the shared scratch folder."""
    return f"{scratch_root(spark)}/{stem}-{uuid.uuid4().hex}"


_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, stem: str = "cut", free: bool = False) -> DataFrame:
    """Write `df` as a table in the shared scratch folder and read it back.

    Used where a derived table feeds several branches: the work upstream is done once and the
    result survives lost executors, which a cache does not. With `free` Spark deletes the write's shuffle files when it is done.
    """
    path, conf = scratch_path(df.sparkSession, stem), df.sparkSession.conf
    before = conf.get(_FREE, None)
    if free:
        conf.set(_FREE, "true")
    try:
        df.write.parquet(path)
    finally:
        if free:
            conf.unset(_FREE) if before is None else conf.set(_FREE, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a scan with fewer splits than cores over all cores before CPU-heavy row work.

    Small inputs only: a table with at least as many splits as there are cores, so any large one, is
    returned as it is and never shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
