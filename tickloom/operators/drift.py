"""Drift between a reference and a current table, and quality of predicted labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.profile import unpivot
from tickloom.operators.ranks import ordered_prefix
from tickloom.sources.runs import publish_run, scan_runs

REPORT = (
    "check string, column string, reference string, current string, shift_pct double, drifted boolean"
)
# A mean has shifted when it moved by over a tenth of itself and by more than this.
MEAN_SHARE, MEAN_FLOOR, SHIFT_EPSILON = 0.1, 1e-5, 1e-9


def _facts(ref: DataFrame, rows: list[tuple[str, str, str, str, bool]]) -> DataFrame:
    """Facts known from the schemas alone, as report rows."""
    return ref.sparkSession.createDataFrame([(c, n, r, k, None, d) for c, n, r, k, d in rows], REPORT)


def column_count_drift(ref: DataFrame, cur: DataFrame) -> DataFrame:
    a, b = len(ref.columns), len(cur.columns)
    return _facts(ref, [("column_count", "*", str(a), str(b), a != b)])


def dtype_drift(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """One row per common column, drifted where the types differ."""
    kinds = dict(cur.dtypes)
    return _facts(ref, [("dtype", c, t, kinds[c], t != kinds[c]) for c, t in ref.dtypes if c in kinds])


def comparable_columns(ref: DataFrame, cur: DataFrame) -> list[str]:
    """Numeric columns both tables have with the same type."""
    other = {f.name: f.dataType for f in cur.schema}
    return [f.name for f in ref.schema if isinstance(f.dataType, T.NumericType) and other.get(f.name) == f.dataType]


def mean_shift(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """Means of every comparable column on both sides: one aggregate per table."""
    columns = comparable_columns(ref, cur)

    def means(df: DataFrame, name: str) -> DataFrame:
        return unpivot(df.agg(*[F.avg(c).alias(c) for c in columns]), columns, "DOUBLE", value=name)

    both = means(ref, "reference_mean").join(means(cur, "current_mean"), "column")
    moved = F.abs(F.col("reference_mean") - F.col("current_mean"))
    return both.select(
        "column", "reference_mean", "current_mean",
        (moved / (F.abs("reference_mean") + SHIFT_EPSILON) * 100).alias("shift_pct"),
        F.coalesce((moved > MEAN_SHARE * F.abs("reference_mean")) & (moved > MEAN_FLOOR), F.lit(False)).alias("drifted"),
    )


def drift_report(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """All checks in one table; a last row `overall` is drifted when any check is."""
    shifts = mean_shift(ref, cur).select(
        F.lit("mean_shift").alias("check"), "column", F.format_string("%.4f", "reference_mean").alias("reference"),
        F.format_string("%.4f", "current_mean").alias("current"), "shift_pct", "drifted",
    )
    parts = column_count_drift(ref, cur).unionByName(dtype_drift(ref, cur)).unionByName(shifts)
    # The grand total of a grouping set is the overall row, so the tables are aggregated once.
    keys = [c for c in parts.columns if c != "drifted"]
    both = parts.groupingSets([[F.col(k) for k in keys], []], *keys).agg(F.bool_or("drifted").alias("drifted"))
    return both.withColumns({"check": F.coalesce("check", F.lit("overall")), "column": F.coalesce("column", F.lit("*"))})


def _tagged(ref: DataFrame, cur: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """Both tables as (column, value, is_ref, is_cur) counts."""
    a = unpivot(ref, columns, kind).withColumns({"r": F.lit(1), "c": F.lit(0)})
    b = unpivot(cur, columns, kind).withColumns({"r": F.lit(0), "c": F.lit(1)})
    return (
        a.unionByName(b).filter("value IS NOT NULL").groupBy("column", "value")
        .agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    )


def ks_statistic(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Largest gap between the two distribution functions, per column, exact."""
    ranked = ordered_prefix(_tagged(ref, cur, columns, "DOUBLE"), "column", "value", ["r", "c"])
    ref_share = (F.col("before_r") + F.col("r")) / F.col("total_r")
    cur_share = (F.col("before_c") + F.col("c")) / F.col("total_c")
    return ranked.groupBy("column").agg(F.max(F.abs(ref_share - cur_share)).alias("ks"))


def stability_index(ref: DataFrame, cur: DataFrame, column: str, bins: int = 10, floor: float = 1e-6) -> DataFrame:
    """Population stability index over equal steps between the reference's extremes, and its parts."""
    known = ref.filter(F.col(column).isNotNull())
    ends = known.agg(F.struct(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))).scalar()
    value = F.col(column).cast("double")
    step = F.greatest(
        F.least(F.coalesce(F.width_bucket(value, ends["lo"], ends["hi"], F.lit(bins)), F.lit(1)), F.lit(bins)), F.lit(1)
    )
    tagged = known.select(column, F.lit(1).alias("r"), F.lit(0).alias("c")).unionByName(
        cur.filter(F.col(column).isNotNull()).select(column, F.lit(0).alias("r"), F.lit(1).alias("c"))
    )
    both = tagged.groupBy(step.cast("long").alias("bin")).agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    # At most `bins` rows are left here.
    every = Window.partitionBy()
    p = F.greatest(F.col("r") / F.sum("r").over(every), F.lit(floor))
    q = F.greatest(F.col("c") / F.sum("c").over(every), F.lit(floor))
    return both.select(
        "bin", F.col("r").alias("reference"), F.col("c").alias("current"), ((q - p) * F.log(q / p)).alias("psi_part")
    )


def chi_square(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Chi-square of the current category counts against the reference shares; new categories are counted apart."""
    counts = _tagged(ref, cur, columns, "STRING")
    totals = counts.groupBy("column").agg(F.sum("r").alias("_nr"), F.sum("c").alias("_nc"))
    expected = F.col("r") / F.col("_nr") * F.col("_nc")
    return counts.join(totals, "column").groupBy("column").agg(
        F.sum(F.when(F.col("r") > 0, F.pow(F.col("c") - expected, 2) / expected)).alias("chi_square"),
        F.count_if(F.col("r") > 0).alias("categories"),
        F.count_if(F.col("r") == 0).alias("new_categories"),
    )


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(truth, predicted).agg(F.count(F.lit(1)).alias("n"))


def label_quality(df: DataFrame, truth: str, predicted: str, alert_below: float = 0.70) -> DataFrame:
    """Precision, recall and F1 per class, with overall accuracy and whether it is below the alert level."""
    n, nothing = F.col("n"), F.lit(0).cast("long")
    right = F.when(F.col(truth) == F.col(predicted), n).otherwise(nothing)
    # Each cell of the confusion matrix counts for its true and for its predicted class: one pass over the rows.
    sides = F.array(
        F.struct(F.col(truth).alias("class"), n.alias("actual"), nothing.alias("claimed"), right.alias("hit")),
        F.struct(F.col(predicted).alias("class"), nothing.alias("actual"), n.alias("claimed"), nothing.alias("hit")),
    )
    cells = confusion(df, truth, predicted).select(F.inline(sides))
    sums = cells.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("actual", "claimed", "hit")])
    # One row per class is left here.
    every = Window.partitionBy()
    accuracy = F.sum("hit").over(every) / F.sum("actual").over(every)
    precision, recall = F.try_divide("hit", "claimed"), F.try_divide("hit", "actual")
    return sums.select(
        "class", "actual", "claimed", "hit", precision.alias("precision"), recall.alias("recall"),
        F.try_divide(2 * precision * recall, precision + recall).alias("f1"), accuracy.alias("accuracy"),
        (accuracy < alert_below).alias("alert"),
    )


def append_metrics(metrics: DataFrame, path: str, run: str, attempt: int = 0) -> int:
    """Add (key, value, step) of one attempt of a run to a metric table. The same attempt again changes nothing. Returns its rows."""
    return publish_run(metrics.select("key", "value", "step"), path, run, attempt)


def stored_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(run, key, step, value) of a metric table: where attempts of a run give the same step, the latest attempt counts."""
    return scan_runs(spark, path).groupBy("run", "key", "step").agg(F.max_by("value", "attempt").alias("value"))


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """Newest value of each (run, key) of an append-only metric table."""
    return metrics.groupBy("run", "key").agg(F.max_by("value", "step").alias("value"), F.max("step").alias("step"))


def metric_history(states: DataFrame, column: str = "state") -> DataFrame:
    """Metrics of trainer states: one row per entry of `log_history`."""
    schema = "log_history array<struct<step: bigint, eval_loss: double, eval_accuracy: double>>"
    parsed = states.select("run", F.from_json(column, schema)["log_history"].alias("h"))
    entries = parsed.select("run", F.inline("h"))
    long = entries.select(
        "run", "step",
        F.explode(F.map_from_arrays(
            F.array(F.lit("eval_loss"), F.lit("eval_accuracy")), F.array("eval_loss", "eval_accuracy")
        )).alias("key", "value"),
    )
    return long.filter("value IS NOT NULL").select("run", "key", "value", "step")
