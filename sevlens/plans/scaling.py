"""Strong / weak scaling runs (B1, B2) feeding ``operators.reports.scalability``.

Each configuration samples by id hash (stable), spreads the sample round-robin
over ``p`` partitions and times a small random forest.  The loop over a handful
of configurations is driver orchestration; each fit is a distributed job.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import DataFrame

from sevlens.operators import sampling

# Fixed values of the reference experiment.
PARTITIONS = (2, 4, 8, 16)
STRONG_FRACTION = 0.10
WEAK_FRACTIONS = (0.025, 0.05, 0.10, 0.20)
FOREST = dict(numTrees=20, maxDepth=6, seed=42)


def _timed_fit(df: DataFrame, partitions: int) -> float:
    data = sampling.round_robin(df, partitions).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        data.count()   # materialise outside the timed region
        t0 = time.time()
        RandomForestClassifier(featuresCol="features", labelCol="label", **FOREST).fit(data)
        return round(time.time() - t0, 3)
    finally:
        data.unpersist()


def strong_scaling(train: DataFrame, partitions: Sequence[int] = PARTITIONS,
                   fraction: float = STRONG_FRACTION) -> DataFrame:
    """B1: fixed sample, growing partition count -> (partitions, time_s)."""
    sample = sampling.sample_fraction(train, fraction, "ID")
    rows = [(p, _timed_fit(sample, p)) for p in partitions]
    return train.sparkSession.createDataFrame(rows, "partitions int, time_s double")


def weak_scaling(train: DataFrame, fractions: Sequence[float] = WEAK_FRACTIONS,
                 partitions: Sequence[int] = PARTITIONS) -> DataFrame:
    """B2: sample size grows with the partition count -> (partitions, data_fraction, time_s)."""
    rows = [(p, f, _timed_fit(sampling.sample_fraction(train, f, "ID"), p))
            for f, p in zip(fractions, partitions)]
    return train.sparkSession.createDataFrame(rows, "partitions int, data_fraction double, time_s double")
