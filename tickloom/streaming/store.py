"""Result tables of streams: a base, a ring of folders for the newest micro-batches, and a manifest that names what counts.

A micro-batch overwrites its own folder, so a retried one is never counted twice. Every so many micro-batches the folders are
merged into a new base, which counts from the moment its manifest is there; a compaction that is killed changes nothing, as
base, manifest and ring take turns in places that nothing reads any more. Days behind the watermark are final: they move
to a table by day and are not written again. A read opens one base, the ring and the days, however long the stream has run.

Everything is written by Spark alone, so any file system will do, and no file has to be renamed or deleted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Merge = Callable[[DataFrame], DataFrame]
BATCH = T.StructField("batch_id", T.LongType())
MANIFEST = "generation bigint, through bigint, final_before date"
PLACES = 3  # bases and manifests that exist side by side


def newest(keys: Sequence[str]) -> Merge:
    """Rows of the newest micro-batch of each key; `max_by` combines map-side."""

    def merge(rows: DataFrame) -> DataFrame:
        others = [c for c in rows.columns if c not in keys]
        last = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch_id").alias("_row"))
        return last.select(*keys, "_row.*").select(*rows.columns)

    return merge


def sums(keys: Sequence[str]) -> Merge:
    """Sums of all other columns of each key."""

    def merge(rows: DataFrame) -> DataFrame:
        added = [F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in rows.columns if c not in (*keys, "batch_id")]
        return rows.groupBy(*keys).agg(*added, F.max("batch_id").alias("batch_id")).select(*rows.columns)

    return merge


@dataclass
class Store:
    """A table of `schema` at `path`, whose rows are put together by `merge`.

    `period` is the date or time column by which days become final: those that lie the intervals `settled` before the newest
    period that was seen. Without it every row may change for ever.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    merge: Merge = lambda rows: rows
    period: str | None = None
    settled: tuple[str, ...] = ("1 day",)
    every: int = 8

    @property
    def rows(self) -> T.StructType:
        return T.StructType([*self.schema, BATCH])

    def _day(self) -> Column:
        return F.to_date(self.period)

    def _slot(self, table: str, number: int, places: int = PLACES) -> str:
        return f"{self.path}/{table}/slot={number % places}"

    def create(self) -> None:
        """Write the empty table, unless the store is there."""
        try:
            self.manifest()
            return
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
        none = self.spark.createDataFrame([], self.rows)
        none.write.mode("overwrite").parquet(self._slot("deltas", 0))
        none.write.mode("overwrite").parquet(self._slot("bases", 0))
        if self.period:
            none.withColumn("day", self._day()).write.mode("overwrite").parquet(f"{self.path}/final")
        self._publish(0, -1, None)

    def manifest(self) -> Row:
        """The newest manifest: its generation, the last micro-batch of its base, and the first day that is not final."""
        found = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")
        return found.orderBy(F.desc("generation")).select("generation", "through", "final_before").first()

    def _publish(self, generation: int, through: int, final_before: object) -> None:
        row = self.spark.createDataFrame([(generation, through, final_before)], MANIFEST)
        row.coalesce(1).write.mode("overwrite").parquet(self._slot("manifest", generation))

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Put the rows of a micro-batch in place, and compact where it is its turn."""
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).select(*self.rows.names)
        rows.write.mode("overwrite").parquet(self._slot("deltas", batch_id, 2 * self.every))
        if (batch_id + 1) % self.every == 0:
            self.compact(batch_id)

    def _open(self, now: Row) -> DataFrame:
        """Rows that are not final: of the base and of the micro-batches after it."""
        base = self.spark.read.schema(self.rows).parquet(self._slot("bases", now.generation))
        deltas = self.spark.read.schema(self.rows).parquet(f"{self.path}/deltas").select(*self.rows.names)
        return self.merge(base.unionByName(deltas.where(F.col("batch_id") > now.through)))

    def compact(self, through: int) -> None:
        """Make all micro-batches up to `through` part of the base; the days that are final by then leave it."""
        now = self.manifest()
        if now.through >= through:
            return
        rows, final_before = self._open(now), now.final_before
        if self.period:
            end = F.max(F.col(self.period).cast("timestamp"))
            for interval in self.settled:
                end = end - F.expr(f"INTERVAL {interval}")
            final_before = max((d for d in (final_before, rows.agg(F.to_date(end)).first()[0]) if d), default=None)
        if final_before is not None:
            done = rows.where(self._day() < F.lit(final_before)).withColumn("day", self._day())
            # Each day is written once, whole; again only if this compaction is repeated.
            dealt = done.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            dealt.partitionBy("day").parquet(f"{self.path}/final")
            rows = rows.where(F.coalesce(self._day() >= F.lit(final_before), F.lit(True)))
        rows.write.mode("overwrite").parquet(self._slot("bases", now.generation + 1))
        self._publish(now.generation + 1, through, final_before)

    def read(self) -> DataFrame:
        """The table as of the newest micro-batch, each row with the `batch_id` that it comes from."""
        now = self.manifest()
        rows = self._open(now)
        if now.final_before is None:
            return rows
        final = self.spark.read.schema(T.StructType([*self.rows, T.StructField("day", T.DateType())])).parquet(f"{self.path}/final")
        return rows.unionByName(final.where(F.col("day") < F.lit(now.final_before)).drop("day"))
