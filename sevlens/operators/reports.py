"""Report tables (R1-R6, S11, B3, B4) as DataFrames ready for CSV export.

Row counts, null rates, sizes and times of the stages are observed while the stages
are written, in one pass each, and saved as a table that the reports read back.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sevlens.operators import evaluate
from sevlens.operators.windows import union_reports
from sevlens.sources import files

COST_PER_CORE_HOUR = 0.10


LINEAGE = ("step int, name string, source string, rows bigint, format string, columns int, null_cells bigint, "
           "stored_bytes bigint, seconds double, partitions int")


@dataclass
class Stage:
    """A pipeline stage: ``path`` is where its rows are written, None for one that only passes them on."""

    name: str
    source: str
    format: str
    frame: DataFrame
    path: str | None = None
    partition_by: str | None = None


def run_stages(spark: SparkSession, stages: Iterable[Callable[[], Stage]], path: str) -> DataFrame:
    """Run each stage once, save what its write observed, and read the lineage back from ``path``.

    Each item makes its stage when its turn comes, so it can read what the ones before have written.  A stage
    is one pass over its input: rows and null cells are observed on the write (or, without a path,
    on a sink that keeps nothing), never counted again.
    """
    rows = []
    for step, make in enumerate(stages, 1):
        stage = make()
        out, seen = files.observed(stage.frame)
        began = time.time()
        if stage.path is None:
            out.write.format("noop").mode("overwrite").save()
        elif stage.partition_by:
            files.write_partitioned(out, stage.path, stage.partition_by)
        else:
            files.write_parquet(out, stage.path)
        seconds = round(time.time() - began, 3)
        where = stage.path and (files.stored_bytes(spark, stage.path), files.partition_dirs(spark, stage.path))
        size, parts = where or (None, None)
        rows.append((step, stage.name, stage.source, seen.get["rows"], stage.format, len(stage.frame.columns), seen.get["null_cells"], size, seconds, parts))
    files.write_metrics(spark.createDataFrame(rows, LINEAGE), path)
    return files.read_metrics(spark, path, LINEAGE)


def _null_rate() -> Column:
    """Share of null cells, in per cent."""
    cells = F.col("rows") * F.col("columns")
    return F.round(F.coalesce(F.try_divide(F.col("null_cells") * F.lit(100.0), cells), F.lit(0.0)), 4)


def lineage(saved: DataFrame) -> DataFrame:
    """(step, name, source, rows, format, null_rate_pct) of a saved lineage."""
    return saved.select("step", "name", "source", "rows", "format", _null_rate().alias("null_rate_pct"))


def pipeline_quality(saved: DataFrame, measure: bool = False) -> DataFrame:
    """Stage, Row_Count, Format, Null_Rate_Pct [, Storage_MB, Partition_Count, Processing_Time_s] of a saved lineage.

    The added columns depend on the machine: size and partition folders of the written files, time of the one pass.
    """
    out = [F.col("name").alias("Stage"), F.col("rows").alias("Row_Count"), F.col("format").alias("Format"), _null_rate().alias("Null_Rate_Pct")]
    if measure:
        out += [F.round(F.col("stored_bytes") / (1024 * 1024), 3).alias("Storage_MB"), F.col("partitions").alias("Partition_Count"),
                F.col("seconds").alias("Processing_Time_s")]
    return saved.orderBy("step").select(*out)


def model_performance(preds: DataFrame, multiclass: Mapping[str, str], binary: Mapping[str, tuple[str, str]],
                      label: str = "label", binary_label: str = "binary_label",
                      framework: str = "Spark MLlib", digits: int = 4) -> DataFrame:
    """R2: multiclass rows (accuracy, f1, precision, recall) and binary rows (accuracy, AUC),
    concatenated by name with nulls where a metric does not apply."""
    mc = evaluate.evaluate_all(preds, multiclass, label, digits=digits).select(
        F.col("model").alias("Model"), F.lit(framework).alias("Framework"),
        F.lit("Multiclass").alias("Task"), F.col("accuracy").alias("Test_Accuracy"),
        F.col("f1").alias("Test_F1"), F.col("precision").alias("Test_Precision"),
        F.col("recall").alias("Test_Recall"))
    parts = [mc]
    for name, (pred_col, score_col) in binary.items():
        acc = evaluate.accuracy(preds, binary_label, pred_col).select(
            F.round("accuracy", digits).alias("Test_Accuracy"))
        groups = evaluate.score_groups(preds, {name: score_col}, binary_label,
                                       positive={name: F.col(binary_label) == 1})
        auc = evaluate.roc_auc(groups, digits).select(F.col("auc").alias("AUC_ROC"))
        parts.append(acc.select(F.lit(name).alias("Model"), F.lit(framework).alias("Framework"),
                                F.lit("Binary").alias("Task"), "Test_Accuracy",
                                auc.select(F.first("AUC_ROC")).scalar().alias("AUC_ROC")))
    return union_reports(*parts)


def efficiency(timings: DataFrame, kind_col: str = "Scaling_Type", parts_col: str = "partitions",
               time_col: str = "time_s") -> DataFrame:
    """strong = t0 / (t * p / p0), weak = t0 / t, speed-up = t0 / t, against the
    smallest partition count of each scaling type (W4)."""
    w = Window.partitionBy(kind_col).orderBy(parts_col).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    t0, p0 = F.first(time_col).over(w), F.first(parts_col).over(w)
    t, p = F.col(time_col), F.col(parts_col)
    strong = F.try_divide(t0, t * p / p0)
    weak = F.try_divide(t0, t)
    return timings.withColumns({
        "Speedup": F.round(F.try_divide(t0, t), 4),
        "Efficiency": F.round(F.when(F.col(kind_col) == "Strong", strong).otherwise(weak), 4)})


def cost(timings: DataFrame, rate: float = COST_PER_CORE_HOUR, parts_col: str = "partitions",
         time_col: str = "time_s") -> DataFrame:
    """T / 3600 * partitions * rate (one core per partition)."""
    return timings.withColumn("Estimated_Cost_USD", F.round(
        F.col(time_col) / F.lit(3600.0) * F.col(parts_col) * F.lit(rate), 6))


def scalability(strong: DataFrame, weak: DataFrame) -> DataFrame:
    """Strong and weak runs with efficiency and cost in one table."""
    both = union_reports(strong.withColumn("Scaling_Type", F.lit("Strong")),
                         weak.withColumn("Scaling_Type", F.lit("Weak")))
    return cost(efficiency(both))


def business_insights(preds: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per (State, Hour, Month, Predicted_Severity) counts, correct ones and accuracy."""
    from sevlens.operators.aggregate import prediction_insights
    return prediction_insights(preds, label, prediction)


def ci_table(preds: DataFrame, models, label: str = "label", replicates: int = 500,
             seed: int = 42) -> DataFrame:
    """Bootstrap accuracy intervals per model (Model, Mean_Accuracy, CI_Lower, CI_Upper, CI_Width)."""
    return evaluate.bootstrap_ci(preds, models, label, replicates=replicates, seed=seed)
