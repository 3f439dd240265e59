"""Multi-key aggregates over predictions (A4 / R3) and arg-max."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sevlens.operators.evaluate import best_by  # noqa: F401  (A6 lives with the metrics)


def prediction_insights(preds: DataFrame, label: str = "label", prediction: str = "prediction",
                        ts: str = "Start_Time", state: str = "State") -> DataFrame:
    """Per (State, Hour, Month, Predicted_Severity): incidents, correct ones, accuracy.

    Rows with a null key are left out, as a pandas group-by would.  Partial
    aggregation runs on every task, so a state holding a third of the rows is
    combined map-side before the shuffle.
    """
    keyed = preds.select(
        F.col(state).alias("State"), F.hour(ts).alias("Hour"), F.month(ts).alias("Month"),
        (F.col(prediction) + 1).alias("Predicted_Severity"),
        (F.col(label) == F.col(prediction)).cast("int").alias("Correct"))
    keyed = keyed.dropna(subset=["State", "Hour", "Month", "Predicted_Severity"])
    out = keyed.groupBy("State", "Hour", "Month", "Predicted_Severity").agg(
        F.count(F.lit(1)).alias("Accident_Count"),
        F.sum("Correct").cast("bigint").alias("Correct_Preds"))
    return out.withColumn("Prediction_Accuracy",
                          F.round(F.col("Correct_Preds") / F.col("Accident_Count"), 6))
