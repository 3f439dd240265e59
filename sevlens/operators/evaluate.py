"""Model evaluation computed on DataFrames.

Input contract: a predictions frame with a label column, one or more prediction
columns and, for curves, one score column per class.  No prediction row is
collected: every metric is an aggregate, and the per-class tables have K or
K x K rows (K = number of classes).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sevlens.functions.hashing import unit_hash
from sevlens.operators.windows import running_sums
from sevlens.session import materialize


def _ratio(num: Column, den: Column) -> Column:
    """num / den with 0 / 0 -> 0.0 (the zero-division convention of the reports)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


# ---------------------------------------------------------------- counts -----

def stack_models(preds: DataFrame, models: Mapping[str, str], label: str = "label",
                 keep: Sequence[str] = ()) -> DataFrame:
    """(model, label, prediction[, keep...]) from one scored frame with a column per model."""
    structs = [F.struct(F.lit(name).alias("model"), F.col(col).cast("double").alias("prediction"))
               for name, col in models.items()]
    return preds.select(F.col(label).cast("double").alias("label"), *keep,
                        F.explode(F.array(*structs)).alias("__m")).select(
        "__m.model", "label", "__m.prediction", *keep)


def _rows(weight: str | None) -> Column:
    """Number of rows of a group; a row of a table of counts stands for ``weight`` rows."""
    return (F.sum(weight) if weight else F.count(F.lit(1))).alias("count")


def pair_counts(preds: DataFrame, label: str = "label", prediction: str = "prediction",
                by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """(by..., label, prediction, count): partial aggregation per task, K x K rows per group."""
    return (preds.groupBy(*by, F.col(label).cast("double").alias("label"),
                          F.col(prediction).cast("double").alias("prediction"))
            .agg(_rows(weight)))


def prediction_counts(preds: DataFrame) -> DataFrame:
    """(columns..., count) of a frame that holds labels and predictions alone, counted in one pass and written once.

    Its rows are combinations of classes, however many rows ``preds`` has; the metrics take it with ``weight="count"``.
    """
    return materialize(preds.groupBy(*preds.columns).agg(_rows(None)))


def model_pair_counts(preds: DataFrame, models: Mapping[str, str], label: str = "label", weight: str | None = None) -> DataFrame:
    """(model, label, prediction, count): one aggregate over (label, every model's prediction),
    and only its few rows are repeated for each model, never the data's."""
    cube = preds.groupBy(F.col(label).cast("double").alias("label"), *[
        F.col(c).cast("double").alias(f"__p{i}") for i, c in enumerate(models.values())]).agg(_rows(weight))
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"__p{i}").alias("prediction")) for i, m in enumerate(models)]))
    return cube.select("label", "count", each.alias("__m")).select("__m.model", "label", "__m.prediction", "count")


def confusion(preds: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """K x K confusion matrix in long form, zero cells included, K = classes seen in either column."""
    counts = materialize(pair_counts(preds, label, prediction))    # K x K rows, read twice below
    classes = counts.select(F.explode(F.array("label", "prediction")).alias("c")).distinct()
    all_classes = classes.agg(F.sort_array(F.collect_list("c"))).scalar()
    grid = classes.select(F.col("c").alias("label"), F.explode(all_classes).alias("prediction"))
    return (grid.join(counts, ["label", "prediction"], "left")
            .select("label", "prediction", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))
            .orderBy("label", "prediction"))


def confusion_norm(preds: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Row-normalised confusion: count / row total (0 for an empty row)."""
    cm = confusion(preds, label, prediction)
    row_total = F.sum("count").over(Window.partitionBy("label"))
    return cm.withColumn("rate", F.round(_ratio(F.col("count"), row_total), 6))


def _class_table(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per (by..., class): tp, predicted, support; every cell counts for its label and for its prediction."""
    by, zero = list(by), F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(zero)
    sides = F.explode(F.array(
        F.struct(F.col("label").alias("class"), hit.alias("tp"), zero.alias("predicted"), F.col("count").alias("support")),
        F.struct(F.col("prediction").alias("class"), zero.alias("tp"), F.col("count").alias("predicted"), zero.alias("support"))))
    return (counts.select(*by, sides.alias("__c")).select(*by, "__c.*").groupBy(*by, "class")
            .agg(*[F.sum(c).cast("bigint").alias(c) for c in ("tp", "predicted", "support")]))


def class_report(preds: DataFrame, label: str = "label", prediction: str = "prediction",
                 digits: int = 6) -> DataFrame:
    """Per-class precision / recall / f1 / support plus 'macro avg' and 'weighted avg' rows."""
    t = _class_table(pair_counts(preds, label, prediction))
    per = t.select(
        F.col("class").cast("string").alias("class"),
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
        "support")
    n, three = F.sum("support"), ("precision", "recall", "f1")
    # the K class rows and both averages from one aggregate
    macro = F.struct(F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in three], n.cast("bigint").alias("support"))
    weighted = F.struct(F.lit("weighted avg").alias("class"), *[_ratio(F.sum(F.col(m) * F.col("support")), n).alias(m) for m in three],
                        n.cast("bigint").alias("support"))
    rows = per.agg(F.collect_list(F.struct("class", *three, "support")).alias("own"), macro.alias("macro"), weighted.alias("weighted"))
    out = rows.select(F.explode(F.concat("own", F.array("macro", "weighted"))).alias("r")).select("r.*")
    return out.withColumns({m: F.round(m, digits) for m in three})


def evaluate_all(preds: DataFrame, models: Mapping[str, str], label: str = "label",
                 digits: int = 6, weight: str | None = None) -> DataFrame:
    """(model, accuracy, f1, precision, recall): weighted metrics as MLlib defines them.

    All follow from one count of (label, every model's prediction).
    """
    res = _weighted_metrics(model_pair_counts(preds, models, label, weight), ["model"])
    return res.withColumns({m: F.round(m, digits) for m in ("accuracy", "f1", "precision", "recall")})


def _weighted_metrics(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., accuracy, f1, precision, recall) from (by..., label, prediction, count)."""
    by = list(by)
    t = _class_table(counts, by)
    per = t.select(*by, "support", "tp",
                   _ratio(F.col("tp"), F.col("predicted")).alias("p"),
                   _ratio(F.col("tp"), F.col("support")).alias("r"),
                   _ratio(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f"))
    n = F.sum("support")
    return per.groupBy(*by).agg(
        _ratio(F.sum("tp"), n).alias("accuracy"),
        _ratio(F.sum(F.col("f") * F.col("support")), n).alias("f1"),
        _ratio(F.sum(F.col("p") * F.col("support")), n).alias("precision"),
        _ratio(F.sum(F.col("r") * F.col("support")), n).alias("recall"))


def accuracy(preds: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return preds.agg(F.round(F.avg((F.col(label) == F.col(prediction)).cast("double")), 6)
                     .alias("accuracy"))


def weighted_f1(preds: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return evaluate_all(preds, {"m": prediction}, label).select("f1")


def weighted_pr(preds: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return evaluate_all(preds, {"m": prediction}, label).select("precision", "recall")


def best_by(metrics: DataFrame, metric: str = "f1", name_col: str = "model") -> DataFrame:
    """The name with the largest metric (ties: smallest name) and its value."""
    best = metrics.orderBy(F.desc(metric), F.asc(name_col)).limit(1)
    return best.select(F.col(name_col).alias(f"best_{name_col}"), F.col(metric).alias(f"best_{metric}"))


# ---------------------------------------------------------------- curves -----

def score_groups(preds: DataFrame, scores: Mapping, label: str = "label",
                 positive: Mapping | None = None) -> DataFrame:
    """(class, score, p, n): positives / negatives per distinct score, one-vs-rest.

    ``scores`` maps class value -> score column.  ``positive`` optionally maps
    class value -> boolean Column (default: label == class).
    """
    structs = []
    for cls, col in scores.items():
        pos = (positive or {}).get(cls, F.col(label) == F.lit(cls))
        structs.append(F.struct(F.lit(str(cls)).alias("class"),
                                F.col(col).cast("double").alias("score"),
                                F.when(pos, 1).otherwise(0).alias("pos")))
    stacked = preds.select(F.explode(F.array(*structs)).alias("s")).select("s.*")
    groups = (stacked.groupBy("class", "score")
              .agg(F.sum("pos").cast("bigint").alias("p"),
                   F.sum(1 - F.col("pos")).cast("bigint").alias("n")))
    # Read four times (size, range bounds, class totals, the sums themselves):
    # scan and aggregate the predictions once.
    return materialize(groups)


def _cumulated(groups: DataFrame) -> DataFrame:
    """Running positives / negatives by descending score, plus class totals."""
    cum = running_sums(groups, ["class"], "score", ["p", "n"], descending=True)
    totals = groups.groupBy("class").agg(F.sum("p").alias("pos_total"), F.sum("n").alias("neg_total"))
    return cum.join(F.broadcast(totals), "class")   # one row per class


def roc_curve(groups: DataFrame, digits: int = 6) -> DataFrame:
    """(class, threshold, fpr, tpr): one point per distinct score plus the (0, 0) start
    (threshold null).  Collinear points are kept; the area is unchanged."""
    c = _cumulated(groups)
    pts = c.select("class", F.col("score").alias("threshold"),
                   F.round(_ratio(F.col("cum_n"), F.col("neg_total")), digits).alias("fpr"),
                   F.round(_ratio(F.col("cum_p"), F.col("pos_total")), digits).alias("tpr"))
    start = groups.select("class").distinct().select(
        "class", F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(start)


def roc_auc(groups: DataFrame, digits: int = 6) -> DataFrame:
    """(class, auc): exact area, tied scores count 1/2 (trapezoid over score groups)."""
    c = _cumulated(groups)
    contrib = F.col("n") * (F.col("cum_p") - F.col("p") / F.lit(2.0))
    return (c.groupBy("class").agg(
        F.round(_ratio(F.sum(contrib), F.max("pos_total") * F.max("neg_total").cast("double")), digits).alias("auc")))


def pr_curve(groups: DataFrame, digits: int = 6) -> DataFrame:
    """(class, threshold, precision, recall) per distinct score plus the end point
    precision 1 / recall 0 (threshold null)."""
    c = _cumulated(groups)
    pts = c.select("class", F.col("score").alias("threshold"),
                   F.round(_ratio(F.col("cum_p"), F.col("cum_p") + F.col("cum_n")), digits).alias("precision"),
                   F.round(_ratio(F.col("cum_p"), F.col("pos_total")), digits).alias("recall"))
    end = groups.select("class").distinct().select(
        "class", F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def avg_precision(groups: DataFrame, digits: int = 6) -> DataFrame:
    """(class, ap) with AP = sum_i (R_i - R_{i-1}) * P_i over descending score groups."""
    c = _cumulated(groups)
    step = _ratio(F.col("p"), F.col("pos_total")) * _ratio(F.col("cum_p"), F.col("cum_p") + F.col("cum_n"))
    return c.groupBy("class").agg(F.round(F.sum(step), digits).alias("ap"))


# ------------------------------------------------------- statistical tests -----

def mcnemar(preds: DataFrame, a: str, b: str, label: str = "label", alpha: float = 0.05) -> DataFrame:
    """McNemar test of two prediction columns (continuity-corrected chi-square, 1 dof).

    Counts come from one aggregate; the p-value erfc(sqrt(chi2 / 2)) is evaluated
    on the single result row.
    """
    ca = F.col(a) == F.col(label)
    cb = F.col(b) == F.col(label)
    t = preds.agg(F.count_if(ca & cb).alias("n11"), F.count_if(ca & ~cb).alias("n10"),
                  F.count_if(~ca & cb).alias("n01"), F.count_if(~ca & ~cb).alias("n00"))
    chi2 = F.try_divide(F.pow(F.abs(F.col("n10") - F.col("n01")) - 1, 2), F.col("n10") + F.col("n01"))
    t = t.withColumn("chi2", F.round(chi2, 6))
    t = t.withColumn("p_value", F.round(_chi2_sf_1dof(F.col("chi2")), 6))
    return t.withColumn("significant", F.coalesce(F.col("p_value") < alpha, F.lit(False)))


@F.pandas_udf(T.DoubleType())
def _chi2_sf_1dof(chi2: pd.Series) -> pd.Series:
    from math import erfc, sqrt
    return chi2.map(lambda x: float("nan") if pd.isna(x) else erfc(sqrt(x / 2.0)))


#: A count of mean m is drawn from [m - SPAN * sqrt(m) - SPAN, m + SPAN * sqrt(m) + SPAN]; what lies outside is below 2^-32.
POISSON_SPAN = 10
_TABLE_BLOCK = 4096


def poisson_draws(counts: DataFrame, cell: Sequence[str], replicates: int, seed: int = 42) -> DataFrame:
    """(cell..., replicate, count): every count redrawn as a Poisson count of that mean, once a replicate.

    The draw is the smallest k whose cumulative probability reaches the uniform that md5
    gives for (seed, cell, replicate): the same on every engine, partitioning and retry.
    A cell's cumulative table has about 20 sqrt(count) rows, made from the ratios
    m / k of neighbouring probabilities; table and uniforms meet in one sort by value.
    """
    cell, m = list(cell), F.col("count")
    reach = F.sqrt(m) * POISSON_SPAN + POISSON_SPAN
    lo, hi = F.greatest(F.floor(m - reach), F.lit(0)).cast("bigint"), F.ceil(m + reach).cast("bigint")
    cells = materialize(counts.where(m > 0).select(*cell, "count", lo.alias("__lo"), hi.alias("__hi")))
    blocks = cells.withColumn("__b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("__hi") - F.col("__lo")) / _TABLE_BLOCK))))
    start = F.col("__lo") + F.col("__b") * _TABLE_BLOCK
    ks = blocks.withColumn("__k", F.explode(F.sequence(start, F.least(start + (_TABLE_BLOCK - 1), F.col("__hi")))))
    one, upto = Window.partitionBy(*cell), Window.partitionBy(*cell).orderBy("__k").rowsBetween(Window.unboundedPreceding, 0)
    ratio = F.when(F.col("__k") > F.col("__lo"), F.log(m.cast("double")) - F.log(F.col("__k").cast("double"))).otherwise(0.0)
    table = ks.withColumn("__log", F.sum(ratio).over(upto))
    table = table.withColumn("__w", F.exp(F.col("__log") - F.max("__log").over(one)))
    table = table.select(*cell, (F.sum("__w").over(upto) / F.sum("__w").over(one)).alias("__at"), "__k", "__hi",
                         F.lit(None).cast("int").alias("replicate"))
    drawn = cells.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    key = F.concat_ws(":", *[F.col(c).cast("string") for c in cell], F.col("replicate").cast("string"))
    drawn = drawn.select(*cell, unit_hash(key, f"bootstrap:{seed}").alias("__at"), F.lit(None).cast("bigint").alias("__k"), "__hi", "replicate")
    after = Window.partitionBy(*cell).orderBy(F.desc("__at"), F.desc_nulls_last("__k")).rowsBetween(Window.unboundedPreceding, 0)
    met = table.unionByName(drawn).withColumn("count", F.coalesce(F.min("__k").over(after), "__hi"))
    return met.where(F.col("replicate").isNotNull()).select(*cell, "replicate", "count")


def _interval(values: DataFrame, metric: str, ci: float, digits: int) -> DataFrame:
    """(Model, Mean, CI_Lower, CI_Upper, CI_Width) of a metric over the replicates of each model."""
    alpha = (1.0 - ci) / 2.0
    q = F.percentile(F.col(metric), F.array(F.lit(alpha), F.lit(1.0 - alpha)))
    res = values.groupBy("model").agg(F.avg(metric).alias("mean"), q.alias("__q"))
    low, high = F.col("__q")[0], F.col("__q")[1]
    return res.select(F.col("model").alias("Model"), F.round("mean", digits).alias("Mean"), F.round(low, digits).alias("CI_Lower"),
                      F.round(high, digits).alias("CI_Upper"), F.round(high - low, digits).alias("CI_Width"))


def bootstrap_ci(preds: DataFrame, models: Mapping[str, str], label: str = "label",
                 replicates: int = 500, ci: float = 0.95, seed: int = 42,
                 digits: int = 4) -> DataFrame:
    """Percentile bootstrap CI of accuracy per model (Poisson bootstrap).

    Accuracy only depends on how many resampled rows are correct, and a sum of m
    independent Poisson(1) row weights is Poisson(m).  So the data is reduced to
    (model, correct or not, rows) in one aggregate, and each replicate draws
    two Poisson counts: the work is O(rows) once plus O(models x replicates),
    never rows x replicates.
    """
    counts = model_pair_counts(preds, models, label).groupBy(
        "model", F.coalesce(F.col("label") == F.col("prediction"), F.lit(False)).alias("right")).agg(F.sum("count").alias("count"))
    rows = poisson_draws(counts, ["model", "right"], replicates, seed)
    acc = F.try_divide(F.sum(F.when(F.col("right"), F.col("count")).otherwise(0)).cast("double"), F.sum("count").cast("double"))
    return _interval(rows.groupBy("model", "replicate").agg(acc.alias("acc")), "acc", ci, digits).withColumnRenamed("Mean", "Mean_Accuracy")


def bootstrap_metric_ci(preds: DataFrame, models: Mapping[str, str], metric: str = "f1",
                        label: str = "label", replicates: int = 500, ci: float = 0.95,
                        seed: int = 42, digits: int = 4) -> DataFrame:
    """Percentile bootstrap CI of any confusion-matrix metric (accuracy, weighted
    f1 / precision / recall) per model, without materialising rows x replicates.

    Resampling rows with Poisson(1) weights makes each confusion cell's count a
    Poisson draw with the cell's count as mean, independently across cells.  So
    the data is reduced once to (model, label, prediction) counts and every
    replicate redraws those K x K cells; the metrics are then the same grouped
    aggregates as ``evaluate_all``, keyed by (model, replicate).
    """
    drawn = poisson_draws(model_pair_counts(preds, models, label).groupBy("model", "label", "prediction").agg(F.sum("count").alias("count")),
                          ["model", "label", "prediction"], replicates, seed)
    out = _interval(_weighted_metrics(drawn, ["model", "replicate"]), metric, ci, digits)
    return out.select("Model", F.lit(metric).alias("Metric"), "Mean", "CI_Lower", "CI_Upper", "CI_Width")
