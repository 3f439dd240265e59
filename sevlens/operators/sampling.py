"""Sampling, splitting and partitioning.

Sampling and splits hash the row id (``functions.hashing.unit_hash``) instead of
drawing from per-partition random streams, so a row's split never changes with
the number of partitions, with AQE coalescing, or when a lost task is
recomputed on another executor.  Splits and samples mix their purpose into the
hashed text, so that a sample of a split is a sample and not a prefix of it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sevlens.functions.hashing import unit_hash

SPLIT_WEIGHTS = (0.70, 0.15, 0.15)
SPLIT_NAMES = ("train", "valid", "test")
SEED = 42


def sample_hash(id_col: str, seed) -> Column:
    """Position of a row for sampling, independent of its position for splitting."""
    return unit_hash(id_col, f"sample:{seed}")


def sample_fraction(df: DataFrame, fraction: float, id_col: str = "ID", seed=SEED) -> DataFrame:
    """Stable Bernoulli sample: keep rows whose sampling hash is below ``fraction``."""
    return df.where(sample_hash(id_col, seed) < F.lit(float(fraction)))


#: Ranges of the sampling hash that are counted to find where the n-th row lies.
CAP_RANGES = 4096


def sample_cap(df: DataFrame, n: int, id_col: str = "ID", seed=SEED) -> DataFrame:
    """At most n rows: exactly the n smallest sampling hashes.

    One aggregate counts rows per hash range (a fixed number of them); the ranges up to
    the one that holds the n-th row are kept, so about n + count / CAP_RANGES rows are
    ordered instead of n rows per task.
    """
    h = sample_hash(id_col, seed)
    at = F.floor(h * CAP_RANGES).cast("int").alias("at")
    held, upto = 0, 1.0
    for r in sorted(df.groupBy(at).agg(F.count(F.lit(1)).alias("n")).collect()):
        held += r["n"]
        if held >= n:
            upto = (r["at"] + 1) / CAP_RANGES
            break
    return df.where(h < F.lit(upto)).withColumn("__h", h).orderBy("__h", id_col).limit(n).drop("__h")


def assign_split(df: DataFrame, weights: Sequence[float] = SPLIT_WEIGHTS,
                 names: Sequence[str] = SPLIT_NAMES, id_col: str = "ID", seed=SEED,
                 out: str = "split") -> DataFrame:
    """Add a split name from cumulative weights over the id hash (70/15/15 by default)."""
    total = float(sum(weights))
    h = unit_hash(id_col, seed)
    expr, acc = None, 0.0
    for w, name in list(zip(weights, names))[:-1]:
        acc += w / total
        expr = F.when(h < acc, name) if expr is None else expr.when(h < acc, name)
    expr = F.lit(names[-1]) if expr is None else expr.otherwise(names[-1])
    return df.withColumn(out, expr)


def split(df: DataFrame, weights: Sequence[float] = SPLIT_WEIGHTS,
          names: Sequence[str] = SPLIT_NAMES, id_col: str = "ID", seed=SEED) -> dict[str, DataFrame]:
    """Named disjoint frames covering every row exactly once."""
    tagged = assign_split(df, weights, names, id_col, seed, "__split")
    return {n: tagged.where(F.col("__split") == n).drop("__split") for n in names}


def temporal_split(df: DataFrame, ts_col: str, cutoffs: Sequence, names: Sequence[str] = SPLIT_NAMES,
                   out: str = "split") -> DataFrame:
    """Split by time: rows before cutoffs[0] -> names[0], ..., the rest -> names[-1]."""
    if len(names) != len(cutoffs) + 1:
        raise ValueError("need one more name than cutoffs")
    ts = F.col(ts_col)
    expr = None
    for cut, name in zip(cutoffs, names):
        c = F.lit(cut) if not hasattr(cut, "_jc") else cut
        expr = F.when(ts < c, name) if expr is None else expr.when(ts < c, name)
    return df.withColumn(out, expr.otherwise(names[-1]))


def split_summary(df: DataFrame, split_col: str = "split") -> DataFrame:
    """(split, rows, share): the window runs over the few aggregated rows only."""
    counts = df.groupBy(split_col).agg(F.count(F.lit(1)).alias("rows"))
    total = F.sum("rows").over(Window.partitionBy())
    return counts.withColumn("share", F.round(F.col("rows") / total, 6)).orderBy(split_col)


def repartition_by(df: DataFrame, n: int, *cols: str, spread: int = 1) -> DataFrame:
    """Hash repartition into n on the given columns.

    ``spread=1`` is the plain form (one key -> one task).  With ``spread=k`` each
    key is salted over k tasks by a hash of the whole row, so a key holding a
    third of all rows is cut into k pieces; the salt is deterministic, so a
    recomputed task after executor loss sends every row to the same place.
    """
    if spread <= 1:
        return df.repartition(n, *cols)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(spread))
    return df.repartition(n, *cols, salt)


def ensure_parallelism(df: DataFrame, id_col: str = "ID", min_partitions: int | None = None) -> DataFrame:
    """Spread a frame over at least ``min_partitions`` (default: the cluster's
    default parallelism) by hashing a unique id.

    Iterative MLlib estimators run one task per input partition; a small input
    file is a single split, which would train on one core.  Hashing a unique id
    is balanced and deterministic (a retried task sends rows to the same place).
    When the input is already wider, nothing changes and no shuffle is added.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, id_col)


#: Rows of a training partition, and the fewest partitions.  Neither depends on the cluster.
TRAIN_ROWS, MIN_TRAIN_PARTITIONS = 100_000, 8
#: Beyond 1.25 million rows partitions also grow: there are sqrt(rows / ROWS_PER_SQUARE) of them.
ROWS_PER_SQUARE = 8_000


def training_partitions(rows: int) -> int:
    """Number of partitions of ``rows`` training rows.

    Every task of a tree estimator's level sends the statistics of all nodes of the level, however few rows
    it has, so what is shuffled and sent to the driver follows from the number of partitions.  It grows with the
    square root of the rows, as do the rows of a partition.
    """
    return max(MIN_TRAIN_PARTITIONS, min(-(-rows // TRAIN_ROWS), math.ceil(math.sqrt(rows / ROWS_PER_SQUARE))))


def fixed_partitions(df: DataFrame, rows: int, id_col: str = "ID") -> DataFrame:
    """Partitions that follow from the data alone: their number from the row count, a row's
    partition from the hash of its id, its place in it from the id.

    Estimators that draw random numbers by partition (bootstrap weights of a forest, split
    candidates) then see the same rows in the same order on every cluster and in every retry.
    """
    return df.repartition(training_partitions(rows), id_col).sortWithinPartitions(id_col)


def round_robin(df: DataFrame, n: int) -> DataFrame:
    return df.repartition(n)


def partition_stats(df: DataFrame) -> DataFrame:
    """(partitions, rows, avg_rows, min_rows, max_rows, skew = max / avg), empty partitions included."""
    n_parts = df.rdd.getNumPartitions()
    per = df.groupBy(F.spark_partition_id().alias("pid")).agg(F.count(F.lit(1)).alias("n"))
    stats = per.agg(F.count(F.lit(1)).alias("non_empty"), F.sum("n").alias("rows"),
                    F.min("n").alias("min_nonempty"), F.max("n").alias("max_rows"))
    return stats.select(
        F.lit(n_parts).alias("partitions"),
        F.coalesce(F.col("rows"), F.lit(0)).cast("bigint").alias("rows"),
        F.round(F.coalesce(F.col("rows"), F.lit(0)) / F.lit(n_parts), 4).alias("avg_rows"),
        F.when(F.col("non_empty") < n_parts, F.lit(0)).otherwise(F.col("min_nonempty"))
        .cast("bigint").alias("min_rows"),
        F.coalesce(F.col("max_rows"), F.lit(0)).cast("bigint").alias("max_rows"),
        F.round(F.try_divide(F.col("max_rows") * F.lit(float(n_parts)), F.col("rows")), 4).alias("skew"))


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Persist for the duration of a block that runs several actions; always unpersist."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
