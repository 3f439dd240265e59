"""Parquet scans of the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Self-describing Parquet scan; projection and filters push into the reader."""
    return spark.read.parquet(path)


def table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{base_dir.rstrip('/')}/{name}.parquet")


def inline_table(spark: SparkSession, rows, schema) -> DataFrame:
    """A small dimension from literal rows with an explicit schema (no pandas, no
    inference).  Only for tables whose size is fixed by definition; a dimension
    that grows with the data must be read from storage."""
    return spark.createDataFrame(list(rows), schema)
