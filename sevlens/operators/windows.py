"""Window-shaped operators (W3-W5), a distributed running sum and exact selection by rank.

``running_sums`` is the core of the ROC / PR curves and of the quantiles.  A plain
``sum(..).over(partitionBy(class).orderBy(score))`` puts every distinct score of
a class into one task, and a class may hold a third of all rows.  Here rows
are dealt out by ranges of (class, score), each range is summed on its own,
and a small table of range totals supplies the offset each range starts from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sevlens.session import materialize


def running_sums(df: DataFrame, keys: Sequence[str], order_col: str, measures: Sequence[str],
                 descending: bool = True, ranges: int | None = None) -> DataFrame:
    """Add ``cum_<m>``: inclusive running sum of each measure per key along ``order_col``.

    ``order_col`` must be unique within a key (aggregate to distinct values first).
    One range exchange on (key, order) deals the rows out evenly whatever the keys' sizes;
    every range is summed on its own and starts from the totals of the ranges before it, one row
    per key and range.  ``ranges`` fixes their number; by default adaptive execution merges
    small ones.
    """
    keys = list(keys)
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    by = [*keys, order]
    dealt = df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)
    # written once: the range numbers must be the same for the totals and for the rows
    ranged = materialize(dealt.withColumn("__range", F.spark_partition_id()))
    totals = ranged.groupBy(*keys, "__range").agg(*[F.sum(m).alias(f"__tot_{m}") for m in measures])
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(k).alias(f"__key_{k}") for k in keys], F.col("__range").alias("__of"), *[
        F.coalesce(F.sum(f"__tot_{m}").over(before), F.lit(0)).alias(f"__off_{m}") for m in measures])
    same = F.col("__range") == F.col("__of")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"__key_{k}"))
    w = Window.partitionBy(*keys, "__range").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = ranged.join(offsets, same).drop(*[f"__key_{k}" for k in keys], "__of")
    return (joined.withColumns({f"cum_{m}": F.col(f"__off_{m}") + F.sum(m).over(w) for m in measures})
            .drop("__range", *[f"__off_{m}" for m in measures]))


def select_ranks(df: DataFrame, keys: Sequence[str], value_col: str, probs: Sequence[float],
                 ranges: int | None = None) -> DataFrame:
    """(keys..., prob, value): exact order statistics, the value of rank ceil(prob * n), 1 at least.

    Values are counted per key first (combined before the shuffle, so a much repeated value is one row),
    then :func:`running_sums` gives every distinct value its ranks and only the values
    that hold a wanted rank are kept: no sketch and no task that sees a whole key.
    Null values don't count.
    """
    keys = list(keys)
    counts = df.where(F.col(value_col).isNotNull()).groupBy(*keys, F.col(value_col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranked = running_sums(counts, keys, "value", ["n"], descending=False, ranges=ranges)
    sizes = ranked.groupBy(*[F.col(k).alias(f"__key_{k}") for k in keys]).agg(F.sum("n").alias("__size"))
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"__key_{k}"))
    wanted = F.array(*[F.struct(F.lit(float(p)).alias("prob"),
                                F.greatest(F.ceil(F.lit(float(p)) * F.col("__size")), F.lit(1)).alias("rank")) for p in probs])
    here = F.filter(wanted, lambda x: (x["rank"] <= F.col("cum_n")) & (x["rank"] > F.col("cum_n") - F.col("n")))
    return (ranked.join(sizes, same).select(*keys, "value", F.explode(here).alias("__x"))
            .select(*keys, F.col("__x.prob").alias("prob"), "value"))


def rank_top_n(df: DataFrame, value_col: str, n: int, tie_col: str | None = None,
               rank_col: str = "Rank", by: Sequence[str] = ()) -> DataFrame:
    """Keep the n largest values (per group ``by``) with Rank 1..n.

    Without ``by`` the top n are taken first (TakeOrderedAndProject: n rows per
    task) and only those n rows are numbered; with ``by`` Spark inserts a
    per-group top-n (WindowGroupLimit) below the window.
    """
    order = [F.desc(value_col)] + ([F.asc(tie_col)] if tie_col else [])
    if not by:
        df = df.orderBy(*order).limit(n)
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def baseline_relative(df: DataFrame, group: Sequence[str] | str, order_col: str, value_col: str,
                      out: str = "relative") -> DataFrame:
    """value / value of the first row (smallest ``order_col``) of its group.

    The baseline of each group comes from a partial aggregate (``min_by``), joined
    back on the group key, so no group is ever gathered into one task; the join has no
    hint, adaptive execution picks it from the aggregate's real size.
    """
    group = [group] if isinstance(group, str) else list(group)
    firsts = df.groupBy(*group).agg(F.min_by(value_col, order_col).alias("__first"))
    return (df.join(firsts, group, "left")
            .withColumn(out, F.try_divide(F.col(value_col), F.col("__first"))).drop("__first"))


def union_reports(*dfs: DataFrame) -> DataFrame:
    """Vertical concat by column name; columns missing in a part become null."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out
