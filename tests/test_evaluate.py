"""Metrics against MLlib evaluators and hand-computed values."""

import math

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from sevlens.operators import evaluate, windows


@pytest.fixture(scope="module")
def preds(spark):
    rows = []
    for i in range(400):
        label = float(i % 4)
        pred_a = float((i * 7) % 4) if i % 3 else label
        pred_b = float((i + 1) % 4) if i % 5 else label
        score = ((i * 37) % 101) / 100.0 + (0.3 if label >= 2 else 0.0)
        rows.append((i, label, pred_a, pred_b, round(score, 2)))
    return spark.createDataFrame(rows, "ID long, label double, pred_a double, pred_b double, score double")


@pytest.mark.parametrize("metric,col", [("accuracy", "accuracy"), ("f1", "f1"),
                                        ("weightedPrecision", "precision"), ("weightedRecall", "recall")])
def test_evaluate_all_matches_mllib(preds, metric, col):
    ours = evaluate.evaluate_all(preds, {"a": "pred_a"}).first()[col]
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="pred_a", metricName=metric)
    assert ours == pytest.approx(ev.evaluate(preds), abs=1e-6)


def test_confusion_has_zero_cells(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (2.0, 2.0)], "label double, prediction double")
    cm = {(r.label, r.prediction): r["count"] for r in evaluate.confusion(df).collect()}
    assert len(cm) == 9 and cm[(1.0, 1.0)] == 0 and cm[(1.0, 0.0)] == 1


def test_class_report_zero_division(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0)], "label double, prediction double")
    rep = {r["class"]: r for r in evaluate.class_report(df).collect()}
    assert rep["1.0"].precision == 0.0 and rep["1.0"].recall == 0.0
    assert rep["0.0"].precision == 0.5 and rep["macro avg"].support == 2


def test_auc_matches_unbinned_evaluator(preds):
    p = preds.withColumn("bin", F.when(F.col("label") >= 2, 1.0).otherwise(0.0))
    g = evaluate.score_groups(p, {"b": "score"}, "bin", positive={"b": F.col("bin") == 1})
    ours = evaluate.roc_auc(g).first().auc
    ev = BinaryClassificationEvaluator(labelCol="bin", rawPredictionCol="score", numBins=0)
    assert ours == pytest.approx(ev.evaluate(p), abs=1e-6)


def test_running_sums_ranges_match_single_window(spark):
    rows = [(k % 3, float(i), 1, i % 2) for k in range(3) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, s double, p int, n int")
    one = windows.running_sums(df, ["k"], "s", ["p", "n"])
    a = sorted(tuple(r) for r in one.collect())
    for ranges in (1, 7, 60):
        many = windows.running_sums(df, ["k"], "s", ["p", "n"], ranges=ranges)
        assert a == sorted(tuple(r) for r in many.select(*one.columns).collect())


def test_ranks_are_selected_exactly(spark):
    import math

    rows = [(k, float((i * 37) % 101) if i % 9 else None) for k in ("a", "b", None) for i in range(200 if k else 30)] + [("hot", 5.0)] * 400 + [("none", None)]
    probs = (0.0, 0.05, 0.25, 0.5, 0.95, 1.0)
    for ranges in (None, 1, 13):
        got = {(r.k, r.prob): r.v for r in windows.select_ranks(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", probs, ranges)
               .withColumnRenamed("value", "v").collect()}
        want = {}
        for k in ("a", "b", None, "hot"):
            own = sorted(v for x, v in rows if x == k and v is not None)
            want |= {(k, p): own[max(math.ceil(p * len(own)), 1) - 1] for p in probs}
        assert got == want


def test_curves_start_and_end_points(preds):
    g = evaluate.score_groups(preds, {0: "score"}, "label")
    roc = evaluate.roc_curve(g).collect()
    assert any(r.threshold is None and r.fpr == 0.0 and r.tpr == 0.0 for r in roc)
    assert max(r.fpr for r in roc) == 1.0 and max(r.tpr for r in roc) == 1.0
    pr = evaluate.pr_curve(g).collect()
    assert any(r.threshold is None and r.precision == 1.0 and r.recall == 0.0 for r in pr)
    ap = evaluate.avg_precision(g).first().ap
    assert 0.0 < ap <= 1.0


def test_mcnemar_statistic_and_p(spark):
    # n10 = 15, n01 = 5 -> chi2 = (|15 - 5| - 1)^2 / 20 = 4.05
    rows = ([(1.0, 1.0, 0.0)] * 15 + [(1.0, 0.0, 1.0)] * 5 + [(1.0, 1.0, 1.0)] * 30)
    df = spark.createDataFrame(rows, "label double, a double, b double")
    r = evaluate.mcnemar(df, "a", "b").first()
    assert (r.n11, r.n10, r.n01, r.n00) == (30, 15, 5, 0)
    assert r.chi2 == pytest.approx(4.05)
    assert r.p_value == pytest.approx(math.erfc(math.sqrt(4.05 / 2)), abs=1e-6) and r.significant


def test_bootstrap_ci_brackets_accuracy(preds):
    acc = evaluate.accuracy(preds, "label", "pred_a").first().accuracy
    r = evaluate.bootstrap_ci(preds, {"a": "pred_a"}, replicates=300, seed=7).first()
    assert r.CI_Lower <= acc <= r.CI_Upper
    assert abs(r.Mean_Accuracy - acc) < 0.01
    again = evaluate.bootstrap_ci(preds, {"a": "pred_a"}, replicates=300, seed=7).first()
    assert again == r


def test_best_by(spark):
    df = spark.createDataFrame([("x", 0.5), ("y", 0.7), ("a", 0.7)], "model string, f1 double")
    assert tuple(evaluate.best_by(df).first()) == ("a", 0.7)


def test_bootstrap_metric_ci_brackets_f1(preds):
    f1 = evaluate.evaluate_all(preds, {"a": "pred_a"}).first().f1
    r = evaluate.bootstrap_metric_ci(preds, {"a": "pred_a"}, "f1", replicates=300, seed=3).first()
    assert r.CI_Lower <= f1 <= r.CI_Upper and abs(r.Mean - f1) < 0.02
    acc = evaluate.bootstrap_metric_ci(preds, {"a": "pred_a"}, "accuracy", replicates=300, seed=3).first()
    base = evaluate.bootstrap_ci(preds, {"a": "pred_a"}, replicates=300, seed=3).first()
    assert abs(acc.CI_Width - base.CI_Width) < 0.03       # two exact-in-distribution routes agree


def test_class_report_counts_once(preds):
    report = evaluate.class_report(preds, "label", "pred_a")
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange ") <= 3 and "Join" not in plan
    two = evaluate.evaluate_all(preds, {"a": "pred_a", "again": "pred_a"}).collect()
    assert tuple(two[0])[1:] == tuple(two[1])[1:]


def test_poisson_draws_invert_the_cumulative_table(spark):
    import hashlib

    cells = {"one": 1, "few": 7, "many": 5000}
    frame = spark.createDataFrame([*cells.items(), ("none", 0)], "cell string, count long")
    got = {(r.cell, r.replicate): r["count"] for r in evaluate.poisson_draws(frame, ["cell"], 60, 5).collect()}
    assert got == {(r.cell, r.replicate): r["count"] for r in evaluate.poisson_draws(frame.repartition(7), ["cell"], 60, 5).collect()}
    want = {}
    for cell, m in cells.items():
        for replicate in range(60):
            u = int(hashlib.md5(f"bootstrap:5:{cell}:{replicate}".encode()).hexdigest()[:8], 16) / 2 ** 32
            k, below = 0, math.exp(-m) if m < 700 else 0.0
            while below < u:
                k += 1
                below += math.exp(k * math.log(m) - math.lgamma(k + 1) - m)
            want[cell, replicate] = k
    assert got == want


def test_draws_of_large_counts_stay_small(spark):
    frame = spark.createDataFrame([("hot", 4_000_000_000)], "cell string, count long")
    r = evaluate.poisson_draws(frame, ["cell"], 200).agg(F.count("*").alias("n"), F.avg("count").alias("mean"), F.stddev("count").alias("sd")).first()
    assert r.n == 200 and abs(r["mean"] - 4e9) < 5 * math.sqrt(4e9 / 200) and 0.8 < r.sd / math.sqrt(4e9) < 1.2
