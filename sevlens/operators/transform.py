"""Projections and casts (P1-P8) and the engineered-feature projection.

All of these are narrow projections: no shuffle, fused into whole-stage codegen
with the scan that feeds them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sevlens.functions.features import incident_feature_columns

MODEL_COLUMNS = ("ID", "label", "features", "Start_Time", "State", "Severity", "Region",
                 "Climate_Zone")


def select_model_columns(df: DataFrame, cols: Iterable[str] = MODEL_COLUMNS) -> DataFrame:
    return df.select(*[c for c in cols if c in df.columns])


def add_features(df: DataFrame, **names) -> DataFrame:
    """Append Hour .. Infra_Risk_Score in one projection (see functions.features)."""
    return df.withColumns(incident_feature_columns(**names))


def bools_to_int(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("int") for c in cols})


def label_from_severity(df: DataFrame, col: str = "Severity", out: str = "label") -> DataFrame:
    """0-based class label as double: Severity 1..4 -> 0.0..3.0."""
    return df.withColumn(out, (F.col(col) - 1).cast("double"))


def binary_label(df: DataFrame, label: str = "label", threshold: float = 2.0,
                 out: str = "binary_label") -> DataFrame:
    """1.0 if label >= threshold else 0.0 (null -> 0.0)."""
    return df.withColumn(out, F.when(F.col(label) >= threshold, 1.0).otherwise(0.0))


def with_correct(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Correct flag and the +1 shift back to severity numbers."""
    return df.withColumns({
        "Correct": (F.col(label) == F.col(prediction)).cast("int"),
        "Predicted_Severity": F.col(prediction) + 1,
        "Actual_Severity": F.col(label) + 1,
    })


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def round_columns(df: DataFrame, cols: Iterable[str], digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})
