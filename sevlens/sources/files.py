"""File sources and sinks.

All paths are caller-supplied; on a cluster they must be shared storage (use
``session.scratch_path`` for intermediate tables).  Reads take explicit schemas,
so no inference pass scans the input.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sevlens.session import scratch_path

CORRUPT_COLUMN = "_corrupt_record"
CORRUPT_FLAG = "_is_corrupt"
# Accepts whole seconds (the reference's format) and fractional seconds.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, ts_format: str = TIMESTAMP_FORMAT,
             mode: str = "PERMISSIVE", header: bool = True) -> DataFrame:
    """CSV scan with a fixed schema; malformed fields become null (PERMISSIVE)."""
    return (spark.read.schema(schema).option("header", header).option("mode", mode)
            .option("timestampFormat", ts_format).option("timestampNTZFormat", ts_format)
            .csv(path))


def read_csv_with_corrupt(spark: SparkSession, path: str, schema: T.StructType,
                          ts_format: str = TIMESTAMP_FORMAT) -> DataFrame:
    """Like ``read_csv`` but the raw text of a malformed line lands in ``_corrupt_record``."""
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])
    return (spark.read.schema(full).option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
            .option("timestampFormat", ts_format).option("timestampNTZFormat", ts_format)
            .csv(path))


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, bad rows).

    The text is parsed once: all rows are written as Parquet into the shared folder,
    partitioned by whether they are corrupt, and each side reads its own
    partition alone (a partition filter, no row of the other side is touched).
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "parsed")
    flagged = df.withColumn(CORRUPT_FLAG, F.col(CORRUPT_COLUMN).isNotNull())
    flagged.write.partitionBy(CORRUPT_FLAG).parquet(path)
    back = spark.read.schema(flagged.schema).parquet(path)
    good = back.where(~F.col(CORRUPT_FLAG)).drop(CORRUPT_FLAG, CORRUPT_COLUMN)
    bad = back.where(F.col(CORRUPT_FLAG)).drop(CORRUPT_FLAG)
    return good, bad


def write_csv(df: DataFrame, path: str, ts_format: str = TIMESTAMP_FORMAT, single_file: bool = False) -> str:
    """Header CSV; ``single_file`` coalesces to one part (only for small report tables)."""
    out = df.coalesce(1) if single_file else df
    (out.write.mode("overwrite").option("header", True)
     .option("timestampFormat", ts_format).option("timestampNTZFormat", ts_format).csv(path))
    return path


def export_csv(df: DataFrame, path: str) -> str:
    """S9 for dashboard tables: one header CSV file per table."""
    return write_csv(df, path, single_file=True)


def write_partitioned(df: DataFrame, path: str, keys, compression: str = "snappy",
                      max_records_per_file: int = 5_000_000) -> str:
    """S3: partitioned Parquet, overwrite.

    A rebalance exchange brings the rows of a key together, and adaptive execution
    merges small partitions and splits the ones of hot keys, so a key has one file,
    or as many as its size asks for, instead of one for each scan task that holds it.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    (df.hint("rebalance", *keys).write.mode("overwrite").partitionBy(*keys)
     .option("compression", compression).option("maxRecordsPerFile", max_records_per_file)
     .parquet(path))
    return path


def write_parquet(df: DataFrame, path: str, compression: str = "snappy") -> str:
    df.write.mode("overwrite").option("compression", compression).parquet(path)
    return path


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` and what one pass over it counts while it is written: rows and null cells."""
    seen = Observation()
    nulls = sum((F.col(f"`{c}`").isNull().cast("long") for c in df.columns), F.lit(0).cast("long"))
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(nulls), F.lit(0)).alias("null_cells")), seen


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files under a path, from the file system's own listing."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def partition_dirs(spark: SparkSession, path: str) -> int:
    """Number of partition folders directly under a written table (0 if it has none)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return sum(1 for f in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p) if f.isDirectory() and "=" in f.getPath().getName())


def write_splits(frames: Mapping[str, DataFrame], base: str) -> dict[str, str]:
    """One Parquet directory per split."""
    return {name: write_parquet(df, f"{base.rstrip('/')}/{name}") for name, df in frames.items()}


def schema_map(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def verify_write(spark: SparkSession, path: str, schema: T.StructType, rows_written: int,
                 partition_col: str | None = None) -> DataFrame:
    """Read back and report rows written / read, schema match (by name -> type,
    since a partitioned write moves the key last) and number of partition values.

    ``rows_written`` is what the write itself observed, so the source isn't computed again.
    """
    back = spark.read.parquet(path)
    same_schema = schema_map(back.schema) == schema_map(schema)
    aggs = [F.count(F.lit(1)).alias("rows_read")]
    if partition_col:
        # null keys are written to the default partition: count them as one value
        aggs.append((F.count_distinct(partition_col)
                     + F.max(F.col(partition_col).isNull().cast("int"))).alias("partition_values"))
    got = back.agg(*aggs)
    return (got.withColumn("rows_expected", F.lit(rows_written).cast("bigint"))
            .withColumn("schema_match", F.lit(same_schema))
            .withColumn("rows_match", F.col("rows_expected") == F.col("rows_read")))


def schema_to_json(df: DataFrame) -> str:
    """Schema as JSON text (``StructType.fromJson(json.loads(...))`` reads it back)."""
    return json.dumps(df.schema.jsonValue(), indent=2)


def schema_from_json(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def write_metrics(df: DataFrame, path: str) -> str:
    """Small metric / summary tables as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def read_metrics(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)
