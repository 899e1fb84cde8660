"""The curation job: documents to labelled instruction rows in train and validation files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.curation import instruction_rows
from tickloom.operators.frames import split_column


def finetune_rows(
    docs: DataFrame, key: str, text: str, positive: Sequence[str], negative: Sequence[str],
    share: float = 0.1, seed: int = 42,
) -> DataFrame:
    """Instruction rows with the part (`train` or `validation`) of their document."""
    rows = instruction_rows(docs, text, positive, negative, keep=[key])
    return rows.withColumn("part", split_column(share, seed, key))


def write_finetune(rows: DataFrame, base: str) -> str:
    """JSON lines under `part=train` and `part=validation`, in one pass over the documents."""
    rows.write.mode("overwrite").partitionBy("part").json(base)
    return base


def read_finetune(spark, base: str, part: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(f"{base}/part={part}").withColumn("part", F.lit(part))
