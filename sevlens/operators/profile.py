"""Profiling (EDA) as distributed aggregates.

The reference draws its plots from a driver-side sample; here every statistic is
computed on the full data with partial aggregation, so only the (small) result
leaves the executors.  Quantiles are exact: values are counted, dealt out by ranges
and found by their running counts, so no sketch of every task ends in one reducer and a
class holding a third of all rows is never in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sevlens.operators.validate import long_form
from sevlens.operators.windows import select_ranks

DEFAULT_PROBS = (0.05, 0.25, 0.5, 0.75, 0.95)


def class_distribution(df: DataFrame, col: str = "Severity") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(col)


def missing_report(df: DataFrame, decimals: int = 2) -> DataFrame:
    """(column, missing_pct) for every column with missing_pct > 0, largest first."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"__m_{i}") for i, c in enumerate(cols)])
    items = [(c, {"missing_pct": F.round(F.col(f"__m_{i}") * F.lit(100.0) / F.col("__n"), decimals)})
             for i, c in enumerate(cols)]
    # A global aggregate yields exactly one partition, so sorting within it is a
    # total order and needs no range-partitioning pass.
    return (long_form(agg, items).where(F.col("missing_pct") > 0).coalesce(1)
            .sortWithinPartitions(F.desc("missing_pct"), F.asc("column")))


def describe_numeric(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """(column, count, mean, stddev, min, max) with typed values; stddev is the sample one."""
    cols = list(cols)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"__n_{i}"), F.avg(x).alias(f"__a_{i}"),
                 F.stddev_samp(x).alias(f"__s_{i}"), F.min(x).alias(f"__lo_{i}"),
                 F.max(x).alias(f"__hi_{i}")]
    items = [(c, {"count": F.col(f"__n_{i}"), "mean": F.col(f"__a_{i}"),
                  "stddev": F.col(f"__s_{i}"), "min": F.col(f"__lo_{i}"),
                  "max": F.col(f"__hi_{i}")}) for i, c in enumerate(cols)]
    return long_form(df.agg(*aggs), items)


def quantiles(df: DataFrame, cols: Iterable[str], probs: Sequence[float] = DEFAULT_PROBS,
              ranges: int | None = None) -> DataFrame:
    """(column, prob, value): exact order statistics of every column in one pass (see ``select_ranks``);
    a column without a value has a null for each prob."""
    cols = list(cols)
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])).alias("x")).select("x.*")
    found = select_ranks(stacked, ["column"], "value", probs, ranges)
    every = df.sparkSession.createDataFrame([(c, float(p)) for c in cols for p in probs], "column string, prob double")
    return every.join(found, ["column", "prob"], "left")


def histogram(df: DataFrame, col: str, by: str | None = None, bins: int = 30) -> DataFrame:
    """Equal-width histogram over [min, max] of the full column, optionally per class.

    min / max come from scalar subqueries (evaluated once, shipped as literals),
    so the bucketing is a map-side projection followed by one partial aggregate.
    """
    x = F.col(col).cast("double")
    lo = df.select(F.min(x)).scalar()
    hi = df.select(F.max(x)).scalar()
    width = (hi - lo) / F.lit(float(bins))
    raw_bin = F.when(width > 0, F.floor((x - lo) / width)).otherwise(F.lit(0))
    b = F.least(raw_bin, F.lit(bins - 1)).cast("int")
    keys = ([by] if by else [])
    return (df.where(x.isNotNull())
            .groupBy(*keys, b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("count"),
                 F.min(x).alias("bin_min"), F.max(x).alias("bin_max"))
            .orderBy(*keys, "bin"))


def box_stats(df: DataFrame, col: str, by: str, ranges: int | None = None) -> DataFrame:
    """Per class: min, q1, median, q3, max; all exact order statistics (see ``select_ranks``)."""
    rows = df.select(by, F.col(col).cast("double").alias("__x"))
    ends = rows.groupBy(by).agg(F.min("__x").alias("min"), F.max("__x").alias("max"))
    found = (select_ranks(rows, [by], "__x", (0.25, 0.5, 0.75), ranges).groupBy(F.col(by).alias("__by"))
             .agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))]))
    return (ends.join(found, F.col(by).eqNullSafe(F.col("__by")), "left")
            .select(by, "min", "q1", "median", "q3", "max").orderBy(by))


def count_by(df: DataFrame, expr: Column | str, name: str) -> DataFrame:
    """Count per derived key, e.g. ``count_by(df, F.hour("Start_Time"), "Hour")``."""
    key = F.col(expr) if isinstance(expr, str) else expr
    return df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("count")).orderBy(name)


def top_k(df: DataFrame, col: str, k: int = 10, null_label: str | None = "Unknown") -> DataFrame:
    """The k most frequent values (ties by value, nulls last), null shown as ``null_label``.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps only
    its own top k of the aggregated counts.
    """
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    top = counts.orderBy(F.desc("count"), F.asc_nulls_last(col)).limit(k)
    if null_label is not None:
        top = top.select(F.coalesce(F.col(col).cast("string"), F.lit(null_label)).alias(col), "count")
    return top
