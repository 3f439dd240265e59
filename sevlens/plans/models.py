"""Distributed training, tuning and scoring with MLlib.

The model-ready table is built once: split by id hash, pipeline fitted on the
training split only, every split transformed by the same ``PipelineModel``.
The assembled training rows are persisted (MEMORY_AND_DISK) while the iterative
estimators run over them, scaled as they are read; lost blocks are recomputed from the short lineage.
"""

from __future__ import annotations

import functools
import itertools
import time
from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sevlens.operators import evaluate, sampling, transform
from sevlens.operators.windows import rank_top_n
from sevlens.plans import incidents as inc
from sevlens.plans.pipeline import build_pipeline, scaler, slot_names
from sevlens.sources.tables import table

# Fixed hyper-parameters of the reference runs.
LR_PARAMS = dict(maxIter=100, regParam=0.01, elasticNetParam=0.0, standardization=False,
                 family="multinomial")
RF_PARAMS = dict(numTrees=100, maxDepth=10, minInstancesPerNode=5, featureSubsetStrategy="sqrt", seed=42)
GBT_PARAMS = dict(maxIter=50, maxDepth=5, stepSize=0.1, subsamplingRate=0.8, seed=42)
DT_PARAMS = dict(maxDepth=10, minInstancesPerNode=5, seed=42)
# Execution settings: keep each row's node id
# cached between levels instead of re-walking the trees, checkpointed every 10
# iterations into the shared checkpoint folder, and let one pass split more nodes
# (deep levels that no longer fit one pass draw their feature subsets in another order).
# Measured at sf0.1: forest 83 s -> 40 s.  Boosting gains nothing from it.
TREE_EXECUTION = dict(cacheNodeIds=True, maxMemoryInMB=1024, checkpointInterval=10)
TUNE_GRID = {"numTrees": (50, 100), "maxDepth": (8, 12)}
TUNE_TRAIN_RATIO, TUNE_PARALLELISM = 0.8, 4
READY_COLUMNS = ("ID", "label", "binary_label", "features", "raw_features", "Start_Time", "State",
                 "Severity", "Region", "Climate_Zone", "split")


def model_ready(spark: SparkSession, base_dir: str):
    """(pipeline_model, {split: frame}) with the pipeline fitted on 'train' only."""
    df = inc.enriched_incidents(spark, base_dir)
    df = transform.binary_label(transform.label_from_severity(df))
    # The labelled input feeds the fitting passes of the imputer and the indexer and the transform: persist it
    # for the fit, release it once the training split is materialised.  Lost blocks are recomputed from the scan.
    # One incident stands for one event, so the number of partitions comes from a count of the scan.
    rows = table(spark, base_dir, "events").count()
    df = sampling.fixed_partitions(sampling.assign_split(df), rows).persist(StorageLevel.MEMORY_AND_DISK)
    # The assembled training rows are persisted before they are scaled: the scaler is fitted on them without another
    # run of the stages before it, and mostly sparse vectors are held once instead of next to their dense ones.
    unscaled = build_pipeline(scale=False).fit(df.where(F.col("split") == "train"))
    # A split is taken before the stages: MLlib's indexer and assembler are no expressions that Spark moves a filter
    # across, so a filter after them would read, deal, sort and assemble the rows of the other splits too.
    frames = {s: unscaled.transform(df.where(F.col("split") == s)).select(*[c for c in READY_COLUMNS if c != "features"])
              for s in sampling.SPLIT_NAMES}
    frames["train"] = frames["train"].persist(StorageLevel.MEMORY_AND_DISK)
    frames["train"].count()
    df.unpersist()
    scaled = scaler().fit(frames["train"])
    pipe_model = PipelineModel([*unscaled.stages, scaled])
    frames = {s: scaled.transform(f).select(*READY_COLUMNS) for s, f in frames.items()}
    return pipe_model, frames


def fit_lr(train: DataFrame, **params):
    return LogisticRegression(featuresCol="features", labelCol="label",
                              **{**LR_PARAMS, **params}).fit(train)


def fit_rf(train: DataFrame, **params):
    return RandomForestClassifier(featuresCol="features", labelCol="label",
                                  **{**RF_PARAMS, **TREE_EXECUTION, **params}).fit(train)


def fit_gbt(train: DataFrame, **params):
    """Binary gradient-boosted trees on ``binary_label`` (severity >= 3)."""
    return GBTClassifier(featuresCol="features", labelCol="binary_label",
                         **{**GBT_PARAMS, **params}).fit(train)


def fit_dt(train: DataFrame, **params):
    return DecisionTreeClassifier(featuresCol="features", labelCol="label",
                                  **{**DT_PARAMS, **TREE_EXECUTION, **params}).fit(train)


def score(model, df: DataFrame, prefix: str | None = None) -> DataFrame:
    """JVM-side scoring; optional ``<prefix>_prediction`` / ``_probability`` / ``_raw`` names."""
    out = model.transform(df)
    if prefix:
        out = out.withColumnsRenamed({"prediction": f"{prefix}_prediction",
                                      "probability": f"{prefix}_probability",
                                      "rawPrediction": f"{prefix}_raw"})
    return out


def score_all(df: DataFrame, fits: Mapping[str, tuple], probability: Sequence[str] = ()) -> DataFrame:
    """(labels..., <name>_prediction...[, <name>_probability...]) of name -> (model, label column).

    All models read the same pass over ``df``, so its feature stages run once and not once a model.
    """
    labels = list(dict.fromkeys(label for _, label in fits.values()))
    out = df.select(*labels, "features")
    for name, (model, _) in fits.items():
        out = score(model, out, name)
    return out.select(*labels, *[f"{n}_prediction" for n in fits], *[f"{n}_probability" for n in probability])


def tune_rf(train: DataFrame, grid: Mapping = TUNE_GRID, fraction: float | None = None,
            train_ratio: float = TUNE_TRAIN_RATIO, parallelism: int = TUNE_PARALLELISM, seed: int = 42,
            metric: str = "f1"):
    """E5: search over a grid of forest parameters on all rows of ``train`` (on a stable sample only where a caller gives a ``fraction``).

    The rows are cut in a training and a validation part by a hash of the id, so every cell
    of the grid sees the same rows on every cluster.  ``parallelism`` cells train at a time; a
    cell's metrics come from one count of (label, prediction).  What the grid leaves open
    has MLlib's defaults, as in the reference's search.

    Returns (best model, its parameters, table of (the grid's parameters, train and validation rows,
    accuracy, f1, precision, recall, best)).  Ties go to the first cell.
    """
    names, cells = list(grid), list(itertools.product(*grid.values()))
    rows = train if fraction is None else sampling.sample_fraction(train, fraction, "ID", seed)
    parts = sampling.split(rows, (train_ratio, 1 - train_ratio), ("train", "valid"), "ID", f"tune:{seed}")
    sizes = {}
    for k, df in parts.items():     # as many partitions as follow from the part's own rows, not from those of ``train``
        sizes[k] = df.count()
        parts[k] = sampling.fixed_partitions(df.select("ID", "label", "features"), sizes[k]).persist(StorageLevel.MEMORY_AND_DISK)

    def run(cell):
        model = RandomForestClassifier(featuresCol="features", labelCol="label", seed=seed, **TREE_EXECUTION,
                                       **dict(zip(names, cell))).fit(parts["train"])
        return model, evaluate_model(model.transform(parts["valid"]))
    try:
        with ThreadPool(parallelism) as pool:       # each thread waits for its own Spark jobs
            runs = pool.map(inheritable_thread_target(train.sparkSession)(run), cells)
    finally:
        for df in parts.values():
            df.unpersist()
    best = max(range(len(cells)), key=lambda i: runs[i][1][metric])
    keys = ("accuracy", "f1", "precision", "recall")
    rows = [(*cell, sizes["train"], sizes["valid"], *[float(m[k]) for k in keys], i == best)
            for i, (cell, (_, m)) in enumerate(zip(cells, runs))]
    schema = ", ".join([*[f"{n} int" for n in names], "train_rows bigint", "valid_rows bigint", *[f"{k} double" for k in keys], "best boolean"])
    return runs[best][0], dict(zip(names, cells[best])), train.sparkSession.createDataFrame(rows, schema)


def tuned_forest(frames: Mapping[str, DataFrame], **search) -> tuple:
    """(model, parameters, grid table, its metrics on the whole validation split) of the searched forest."""
    model, params, grid = tune_rf(frames["train"], **search)
    return model, params, grid, evaluate_model(model.transform(frames["valid"]))


def importances(model, names: list[str], n: int = 20) -> DataFrame:
    """Gini importances with slot names, ranked 1..n (one row per feature slot)."""
    spark = _session_of(model)
    vals = model.featureImportances.toArray().tolist()
    rows = [(i, names[i] if i < len(names) else f"slot_{i}", float(v)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "Feature_Index int, Feature_Name string, Importance double")
    return rank_top_n(df, "Importance", n, tie_col="Feature_Index", rank_col="Rank")


def top_importances(model, n: int = 20, names: list[str] | None = None) -> DataFrame:
    """The n largest importances of a tree model, Rank 1..n."""
    size = len(model.featureImportances.toArray())
    return importances(model, names or [f"slot_{i}" for i in range(size)], n)


def importance_table(model, names: list[str], n: int = 20) -> DataFrame:
    """The ranked importance table (alias of ``importances``)."""
    return importances(model, names, n)


def _session_of(model):
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()


def evaluate_model(preds: DataFrame, prediction: str = "prediction", label: str = "label",
                   weight: str | None = None) -> dict:
    """Accuracy / weighted f1 / precision / recall of one scored frame, or of its counts (one small result row)."""
    row = evaluate.evaluate_all(preds, {"m": prediction}, label, weight=weight).first()
    return {k: row[k] for k in ("accuracy", "f1", "precision", "recall")}


def binary_auc(preds: DataFrame, label: str = "binary_label",
               probability: str = "probability") -> float:
    """Exact ROC AUC of P(class 1) with ties counted 1/2 (no binning)."""
    from pyspark.ml.functions import vector_to_array
    p = preds.select(F.col(label).alias("label"),
                     vector_to_array(probability)[1].alias("p1"))
    g = evaluate.score_groups(p, {"binary": "p1"}, "label", positive={"binary": F.col("label") == 1})
    return evaluate.roc_auc(g).first()["auc"]


def sample_vs_full(train: DataFrame, valid: DataFrame, n: int = 100_000,
                   full_fits: Mapping | None = None) -> DataFrame:
    """The same estimators fitted on a capped hash sample and on all training rows.

    ``full_fits`` optionally maps "LR" / "RF" / "GBT" to an already fitted
    (model, seconds) on ``train``, so the full-data fits are not repeated.
    """
    fits, seconds = {}, {}
    sample = sampling.sample_cap(train.select("ID", "label", "binary_label", "features"), n, "ID").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name, fit, label in (("LR", fit_lr, "label"), ("RF", fit_rf, "label"),
                                 ("GBT", fit_gbt, "binary_label")):
            for size_name, frame in ((f"sample_{n}", sample), ("full", train)):
                prefit = (full_fits or {}).get(name) if size_name == "full" else None
                if prefit is not None:
                    model, secs = prefit
                else:
                    t0 = time.time()
                    model = fit(frame)
                    secs = time.time() - t0
                fits[f"{name}_{size_name}"] = (model, label)
                seconds[f"{name}_{size_name}"] = (name, size_name, round(secs, 3))
    finally:
        sample.unpersist()
    counted = evaluate.prediction_counts(score_all(valid, fits))     # one pass over the validation rows for all six
    rows = []
    for key, (_, label) in fits.items():
        m = evaluate_model(counted, f"{key}_prediction", label, "count")
        rows.append((*seconds[key], m["accuracy"], m["f1"]))
    return train.sparkSession.createDataFrame(
        rows, "Model string, Sample_Size string, Train_Time_s double, Val_Accuracy double, Val_F1 double")


def model_facts(frames: Mapping[str, DataFrame], fits: Mapping[str, tuple]) -> DataFrame:
    """What holds of any sound fit, for name -> (model, label column): rows trained on and scored, classes
    of the training labels, the majority's share of them, whether the model is right at least that
    often on the training rows, and whether it predicts known classes only.

    One pass over a split counts (labels, every model's prediction); a model's (label, prediction) follow from those counts.
    """
    out = []
    cube = {k: evaluate.prediction_counts(score_all(frames[k], fits)) for k in ("train", "test")}
    for name, (_, label) in fits.items():
        counted = {k: evaluate.pair_counts(c, label, f"{name}_prediction", weight="count") for k, c in cube.items()}
        own = counted["train"]
        support = own.groupBy("label").agg(F.sum("count").alias("n")).agg(
            F.sum("n").alias("train_rows"), F.count("*").alias("classes"), F.max("n").alias("most"), F.collect_set("label").alias("known"))
        right = own.agg(F.sum(F.when(F.col("label") == F.col("prediction"), F.col("count"))).alias("right"))
        seen = counted["test"].agg(F.sum("count").alias("test_rows"), F.collect_set("prediction").alias("given"))
        facts = support.join(right).join(seen)      # one row each
        out.append(facts.select(
            F.lit(name).alias("model"), "train_rows", "test_rows", "classes", F.round(F.col("most") / F.col("train_rows"), 6).alias("majority_share"),
            (F.coalesce("right", F.lit(0)) >= F.col("most")).alias("not_below_majority"),
            (F.size(F.array_except("given", "known")) == 0).alias("known_classes_only")))
    return functools.reduce(DataFrame.unionByName, out)


def model_summary(spark: SparkSession, results: list[dict]) -> DataFrame:
    """One row per model (train time, accuracy, f1, precision, recall, auc)."""
    schema = ("Model string, Train_Time_s double, Test_Accuracy double, Test_F1 double, "
              "Test_Precision double, Test_Recall double, AUC_ROC double")
    keys = ("Model", "Train_Time_s", "Test_Accuracy", "Test_F1", "Test_Precision", "Test_Recall", "AUC_ROC")
    return spark.createDataFrame([tuple(r.get(k) for k in keys) for r in results], schema)


def feature_names(frames: Mapping[str, DataFrame]) -> list[str]:
    return slot_names(frames["train"], "raw_features")


# Fitted models are reused across the queries of one application (keyed by
# application id and input folder): one pipeline fit, one fit per estimator.
_FITTED: dict = {}


def memo(spark: SparkSession, base_dir: str, key: str, build):
    k = (spark.sparkContext.applicationId, base_dir, key)
    if k not in _FITTED:
        _FITTED[k] = build()
    return _FITTED[k]


def ready(spark: SparkSession, base_dir: str):
    return memo(spark, base_dir, "ready", lambda: model_ready(spark, base_dir))


def fitted(spark: SparkSession, base_dir: str, name: str):
    """(model, train seconds) of 'lr' | 'rf' | 'gbt' | 'dt' on the training split."""
    fits = {"lr": fit_lr, "rf": fit_rf, "gbt": fit_gbt, "dt": fit_dt}

    def build():
        _, frames = ready(spark, base_dir)
        t0 = time.time()
        model = fits[name](frames["train"])
        return model, round(time.time() - t0, 3)
    return memo(spark, base_dir, f"model:{name}", build)
