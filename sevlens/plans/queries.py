"""Registered queries: one per inventory row that yields a table.

Every query reads the input tables under ``base_dir`` (through the incident
model of ``plans.incidents``) over their whole extent; the only ``limit`` is in
top-k / capped-sample rows where the limit is the feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sevlens.operators import (aggregate, enrich, evaluate, profile, reports, sampling, transform,
                               validate, windows)
from sevlens.sources import files
from sevlens.plans import incidents as inc
from sevlens.plans import models

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(key: str):
    def deco(fn):
        REGISTRY[key] = fn
        return fn
    return deco


def featured(spark: SparkSession, base_dir: str) -> DataFrame:
    return transform.add_features(inc.enriched_incidents(spark, base_dir))


@register("flagship_region_hour")
def flagship(spark: SparkSession, base_dir: str) -> DataFrame:
    df = featured(spark, base_dir)
    return (df.groupBy("Region", "Hour")
            .agg(F.count(F.lit(1)).alias("incidents"),
                 F.sum("Is_Peak_Hour").cast("bigint").alias("peak_incidents"),
                 F.sum("Is_Weekend").cast("bigint").alias("weekend_incidents"),
                 F.round(F.avg("Severity"), 6).alias("avg_severity"))
            .orderBy(F.asc_nulls_last("Region"), "Hour"))


# ---- sources -------------------------------------------------------------

@register("s04_parquet_scan")
def s04(spark, base_dir):
    return inc.raw_incidents(spark, base_dir)


@register("s07_state_lookup")
def s07(spark, base_dir):
    return inc.state_lookup(spark, base_dir)


# ---- validation / profiling ------------------------------------------------

@register("v00_ingest_report")
def v00(spark, base_dir):
    return validate.ingest_report(inc.raw_incidents(spark, base_dir))


@register("v01_shape")
def v01(spark, base_dir):
    # State comes from left joins on primary keys: a column more, the same rows
    return validate.shape(inc.raw_incidents(spark, base_dir, state=False).withColumn("State", F.lit(None).cast("string")))


@register("v02_null_report")
def v02(spark, base_dir):
    return validate.null_report(inc.raw_incidents(spark, base_dir))


@register("v03_domain_check")
def v03(spark, base_dir):
    return validate.domain_violations(inc.raw_incidents(spark, base_dir, state=False), "Severity")


@register("v03_domain_check_violated")
def v03_violated(spark, base_dir):
    """The same check on a narrower domain, which the rows of severity 4 break."""
    return validate.domain_violations(inc.raw_incidents(spark, base_dir, state=False), "Severity", (1, 2, 3))


@register("p02_invalid_rows")
def p02(spark, base_dir):
    bad = validate.invalid_rows(inc.enriched_incidents(spark, base_dir), {"Severity": (1, 2, 3)}, validate.US_BOUNDING_BOX,
                                ("Temperature_F", "Region"))
    return bad.select("ID", F.explode("reasons").alias("reason"))


@register("v14_column_presence")
def v14(spark, base_dir):
    return validate.column_presence(inc.enriched_incidents(spark, base_dir), ("ID", "State", "Region", "Climate_Zone", "Sensor"))


@register("v04_range_check")
def v04(spark, base_dir):
    return validate.range_violations(inc.raw_incidents(spark, base_dir, state=False))


@register("v05_class_distribution")
def v05(spark, base_dir):
    return profile.class_distribution(inc.raw_incidents(spark, base_dir, state=False), "Severity")


@register("v06_missing_report")
def v06(spark, base_dir):
    return profile.missing_report(inc.enriched_incidents(spark, base_dir))


@register("v07_describe_numeric")
def v07(spark, base_dir):
    d = profile.describe_numeric(inc.raw_incidents(spark, base_dir, state=False), inc.NUMERIC_COLUMNS)
    return transform.round_columns(d, ["mean", "stddev", "min", "max"], 6)


@register("v08_quantiles")
def v08(spark, base_dir):
    return profile.quantiles(inc.raw_incidents(spark, base_dir, state=False), inc.NUMERIC_COLUMNS)


@register("v09_all_null_columns")
def v09(spark, base_dir):
    return validate.all_null_columns(inc.enriched_incidents(spark, base_dir))


@register("v10_histogram")
def v10(spark, base_dir):
    h = profile.histogram(inc.raw_incidents(spark, base_dir, state=False), "Temperature_F", "Severity", 30)
    return h


@register("v11_box_stats")
def v11(spark, base_dir):
    return profile.box_stats(inc.raw_incidents(spark, base_dir, state=False), "Visibility_mi", "Severity")


@register("v12_count_by_hour")
def v12(spark, base_dir):
    return profile.count_by(inc.raw_incidents(spark, base_dir, state=False), F.hour("Start_Time"), "Hour")


@register("v13_top_states")
def v13(spark, base_dir):
    return profile.top_k(inc.raw_incidents(spark, base_dir), "State", 10)


@register("v13_top_weather")
def v13w(spark, base_dir):
    return profile.top_k(inc.raw_incidents(spark, base_dir, state=False), "Weather_Condition", 10)


@register("v15_feature_bounds")
def v15(spark, base_dir):
    return validate.bounds_report(featured(spark, base_dir), {
        "Hour": (0, 23), "DayOfWeek": (1, 7), "Month": (1, 12), "Duration_Min": (0, 1440),
        "Temp_Risk": (0, 2), "Distance_Bucket": (0, 3), "Infra_Risk_Score": (0, 5)})


# ---- features ---------------------------------------------------------------

@register("h01_incident_features")
def h01(spark, base_dir):
    cols = ["ID", "Hour", "DayOfWeek", "Month", "Year", "Duration_Min", "Is_Peak_Hour",
            "Is_Weekend", "Temp_Risk", "Low_Visibility", "Distance_Bucket", "Is_Night",
            "Infra_Risk_Score"]
    return featured(spark, base_dir).select(*cols)


# ---- joins ------------------------------------------------------------------

@register("j01_enrich")
def j01(spark, base_dir):
    return inc.enriched_incidents(spark, base_dir)


# ---- projections -------------------------------------------------------------

@register("p01_model_columns")
def p01(spark, base_dir):
    df = transform.label_from_severity(inc.enriched_incidents(spark, base_dir))
    return transform.select_model_columns(df)


@register("p03_bools_to_int")
def p03(spark, base_dir):
    df = inc.raw_incidents(spark, base_dir)
    return transform.bools_to_int(df.select("ID", *inc.FLAG_COLUMNS), inc.FLAG_COLUMNS)


@register("p04_labels")
def p04(spark, base_dir):
    """0-based label, binary label, correctness flag, rename, rounding."""
    df = transform.binary_label(inc.rule_predictions(inc.raw_incidents(spark, base_dir, state=False)))
    df = transform.with_correct(df.select("ID", "label", "binary_label", "pred_a", "score"),
                                "label", "pred_a")
    df = transform.rename(df, {"score": "Score"})
    return transform.round_columns(df, ["Score"], 4)


# ---- sampling / splits ------------------------------------------------------------

def _ids(spark, base_dir):
    return inc.raw_incidents(spark, base_dir, state=False).select("ID", "Start_Time", "Severity")


@register("g01_sample_fraction")
def g01(spark, base_dir):
    return sampling.sample_fraction(_ids(spark, base_dir), 0.1, "ID", 42)


@register("g02_sample_cap")
def g02(spark, base_dir):
    return sampling.sample_cap(_ids(spark, base_dir), 1000, "ID", 42)


@register("g01_sample_of_train")
def g01_train(spark, base_dir):
    return sampling.sample_fraction(sampling.split(_ids(spark, base_dir))["train"], 0.2, "ID", 42)


@register("g01_sample_of_test")
def g01_test(spark, base_dir):
    return sampling.sample_fraction(sampling.split(_ids(spark, base_dir))["test"], 0.5, "ID", 42)


@register("g02_cap_of_test")
def g02_test(spark, base_dir):
    return sampling.sample_cap(sampling.split(_ids(spark, base_dir))["test"], 100, "ID", 42)


@register("j03_overlap_of_samples")
def j03_samples(spark, base_dir):
    ids = _ids(spark, base_dir)
    return enrich.split_overlap(sampling.split(ids)["train"], sampling.sample_fraction(ids, 0.1, "ID", 42))


@register("g03_split")
def g03(spark, base_dir):
    return sampling.assign_split(_ids(spark, base_dir)).select("ID", "split")


@register("g04_temporal_split")
def g04(spark, base_dir):
    import datetime as dt
    cut = [dt.datetime(2024, 1, 22), dt.datetime(2024, 1, 26)]
    return sampling.temporal_split(_ids(spark, base_dir), "Start_Time", cut).select("ID", "split")


@register("g05_split_summary")
def g05(spark, base_dir):
    return sampling.split_summary(sampling.assign_split(_ids(spark, base_dir)))


@register("g06_repartition_by_state")
def g06(spark, base_dir):
    return sampling.repartition_by(inc.raw_incidents(spark, base_dir), 10, "State", spread=4)


@register("g07_round_robin")
def g07(spark, base_dir):
    return sampling.round_robin(inc.raw_incidents(spark, base_dir), 16)


@register("g08_partition_stats")
def g08(spark, base_dir):
    return sampling.partition_stats(
        sampling.repartition_by(inc.raw_incidents(spark, base_dir), 10, "State"))


# ---- evaluation on the rule-based predictor ------------------------------------------

CLASS_SCORES = {k: f"score_{k}" for k in range(4)}
MODELS = {"rule_a": "pred_a", "rule_b": "pred_b"}


def _preds(spark, base_dir, state=False):
    return inc.rule_predictions(inc.raw_incidents(spark, base_dir, state=state))


@register("m01_accuracy")
def m01(spark, base_dir):
    return evaluate.accuracy(_preds(spark, base_dir), "label", "pred_a")


@register("m02_weighted_f1")
def m02(spark, base_dir):
    return evaluate.weighted_f1(_preds(spark, base_dir), "label", "pred_a")


@register("m03_weighted_pr")
def m03(spark, base_dir):
    return evaluate.weighted_pr(_preds(spark, base_dir), "label", "pred_a")


@register("m04_evaluate_all")
def m04(spark, base_dir):
    return evaluate.evaluate_all(_preds(spark, base_dir), MODELS)


@register("m05_confusion")
def m05(spark, base_dir):
    return evaluate.confusion(_preds(spark, base_dir), "label", "pred_a")


@register("m06_confusion_norm")
def m06(spark, base_dir):
    return evaluate.confusion_norm(_preds(spark, base_dir), "label", "pred_a")


@register("m07_class_report")
def m07(spark, base_dir):
    return evaluate.class_report(_preds(spark, base_dir), "label", "pred_a")


def _groups(spark, base_dir, binary: bool = False):
    p = _preds(spark, base_dir)
    if binary:
        return evaluate.score_groups(p, {"binary": "score"}, "label",
                                     positive={"binary": F.col("label") >= 2})
    return evaluate.score_groups(p, CLASS_SCORES, "label")


@register("m08_roc_curve")
def m08(spark, base_dir):
    return evaluate.roc_curve(_groups(spark, base_dir))


@register("m09_roc_auc")
def m09(spark, base_dir):
    return evaluate.roc_auc(_groups(spark, base_dir)).unionByName(
        evaluate.roc_auc(_groups(spark, base_dir, binary=True)))


@register("m10_pr_curve")
def m10(spark, base_dir):
    return evaluate.pr_curve(_groups(spark, base_dir))


@register("m11_avg_precision")
def m11(spark, base_dir):
    return evaluate.avg_precision(_groups(spark, base_dir))


@register("m12_bootstrap_ci")
def m12(spark, base_dir):
    return evaluate.bootstrap_ci(_preds(spark, base_dir), MODELS, replicates=500, seed=42)


@register("m12_bootstrap_f1_ci")
def m12f(spark, base_dir):
    return evaluate.bootstrap_metric_ci(_preds(spark, base_dir), MODELS, "f1", replicates=500, seed=42)


@register("m13_mcnemar_table")
def m13(spark, base_dir):
    return evaluate.mcnemar(_preds(spark, base_dir), "pred_a", "pred_b").drop("p_value", "significant")


@register("m13_mcnemar_test")
def m13t(spark, base_dir):
    return evaluate.mcnemar(_preds(spark, base_dir), "pred_a", "pred_b")


@register("m14_best_model")
def m14(spark, base_dir):
    return evaluate.best_by(evaluate.evaluate_all(_preds(spark, base_dir), MODELS), "f1")


@register("j02_join_predictions")
def j02(spark, base_dir):
    p = _preds(spark, base_dir)
    return enrich.join_predictions(p.select("ID", "label", "pred_a"), p.select("ID", "pred_b"))


@register("j03_split_overlap")
def j03(spark, base_dir):
    parts = sampling.split(_ids(spark, base_dir))
    return enrich.split_overlap(parts["train"], parts["test"])


@register("a04_prediction_insights")
def a04(spark, base_dir):
    return aggregate.prediction_insights(_preds(spark, base_dir, state=True), "label", "pred_a")


# ---- sources and sinks (write to the shared scratch folder, read back) ----------------

def _scratch(spark, name):
    from sevlens.session import scratch_path
    return scratch_path(spark, name)


@register("s01_csv_roundtrip")
def s01(spark, base_dir):
    raw = inc.raw_incidents(spark, base_dir)
    path = files.write_csv(raw, _scratch(spark, "incidents-csv"))
    return files.read_csv(spark, path, raw.schema)


@register("s02_corrupt_records")
def s02(spark, base_dir):
    from pyspark.sql import types as T
    src = inc.raw_incidents(spark, base_dir, state=False).select(
        "ID", F.when(F.col("ID") % 97 == 0, F.lit("n/a"))
        .otherwise(F.col("Severity").cast("string")).alias("Severity"), "Distance_mi")
    path = files.write_csv(src, _scratch(spark, "corrupt-csv"))
    schema = T.StructType([T.StructField("ID", T.LongType()), T.StructField("Severity", T.IntegerType()),
                           T.StructField("Distance_mi", T.DoubleType())])
    good, bad = files.split_corrupt(files.read_csv_with_corrupt(spark, path, schema))
    return (good.withColumn("corrupt", F.lit(False))
            .unionByName(bad.drop(files.CORRUPT_COLUMN).withColumn("corrupt", F.lit(True))))


@register("s06_incident_csv_46")
def s06(spark, base_dir):
    """The 46-column file under its raw header, malformed fields included: good and corrupt rows under clean names."""
    from sevlens.sources import incident_csv as wide
    own = inc.raw_incidents(spark, base_dir)
    cols = {wide.CLEAN_NAMES.get(f.name, f.name): f.dataType for f in wide.RAW_SCHEMA}
    rows = own.select(*[(F.col(c) if c in own.columns else F.lit(None)).cast("string" if c == "Severity" else t).alias(c) for c, t in cols.items()])
    rows = rows.withColumn("Severity", F.when(F.col("ID").cast("bigint") % 89 == 0, F.lit("severe")).otherwise(F.col("Severity")))
    path = files.write_csv(wide.raw_names(rows), _scratch(spark, "incidents-46"))
    good, bad = files.split_corrupt(wide.read_incident_csv(spark, path, keep_corrupt=True))
    both = good.withColumn("corrupt", F.lit(False)).unionByName(bad.drop(files.CORRUPT_COLUMN).withColumn("corrupt", F.lit(True)))
    return both.withColumns({c: F.col(c).cast("timestamp_ntz") for c, t in both.dtypes if t == "timestamp"})


def _partitioned(spark, base_dir):
    """(schema, rows observed by the write, path) of the enriched incidents partitioned by state."""
    enriched, seen = files.observed(inc.enriched_incidents(spark, base_dir))
    path = files.write_partitioned(enriched, _scratch(spark, "incidents-by-state"), "State")
    return enriched.schema, seen.get["rows"], path


@register("s03_partitioned_write")
def s03(spark, base_dir):
    _, _, path = _partitioned(spark, base_dir)
    return spark.read.parquet(path)


@register("s05_verify_write")
def s05(spark, base_dir):
    schema, rows, path = _partitioned(spark, base_dir)
    return files.verify_write(spark, path, schema, rows, "State")


@register("s08_write_splits")
def s08(spark, base_dir):
    parts = sampling.split(inc.raw_incidents(spark, base_dir))
    paths = files.write_splits(parts, _scratch(spark, "splits"))
    return _union_all([spark.read.parquet(p).agg(F.count(F.lit(1)).alias("rows"))
                           .select(F.lit(n).alias("split"), "rows") for n, p in paths.items()])


def _union_all(dfs):
    """Row-wise union of same-schema frames."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


@register("s09_export_csv")
def s09(spark, base_dir):
    dist = profile.class_distribution(inc.raw_incidents(spark, base_dir, state=False), "Severity")
    path = files.export_csv(dist, _scratch(spark, "class-distribution-csv"))
    return files.read_csv(spark, path, dist.schema)


def _lineage(spark, base_dir):
    """Lineage of a run whose stages read what the ones before have written, saved and read back."""
    at = {x: _scratch(spark, f"lineage-{x}") for x in ("raw", "by-state", "saved")}
    raw = lambda: spark.read.parquet(at["raw"])
    return reports.run_stages(spark, [
        lambda: reports.Stage("Ingestion", "events+customer+nation", "Parquet", inc.raw_incidents(spark, base_dir), at["raw"]),
        lambda: reports.Stage("Validation", "incidents", "DF", raw()),
        lambda: reports.Stage("Repartition", "incidents", "DF", sampling.repartition_by(raw(), 10, "State", spread=4)),
        lambda: reports.Stage("Enrichment", "incidents+state_lookup", "DF", inc.enriched_incidents(spark, base_dir), at["by-state"], "State"),
        lambda: reports.Stage("Parquet", "incidents_by_state", "Parquet", spark.read.parquet(at["by-state"]))], at["saved"])


@register("s11_lineage")
def s11(spark, base_dir):
    return reports.lineage(_lineage(spark, base_dir))


@register("s12_metrics_json")
def s12(spark, base_dir):
    metrics = evaluate.evaluate_all(_preds(spark, base_dir), MODELS)
    path = files.write_metrics(metrics, _scratch(spark, "metrics-json"))
    return files.read_metrics(spark, path, metrics.schema)


# ---- windows ---------------------------------------------------------------------

@register("w03_top_states_ranked")
def w03(spark, base_dir):
    counts = profile.class_distribution(inc.raw_incidents(spark, base_dir), "State")
    return windows.rank_top_n(counts, "count", 5, tie_col="State")


@register("w04_hourly_vs_first_hour")
def w04(spark, base_dir):
    raw = inc.raw_incidents(spark, base_dir, state=False)
    counts = raw.groupBy("Severity", F.hour("Start_Time").alias("Hour")).agg(
        F.count(F.lit(1)).alias("count"))
    out = windows.baseline_relative(counts, "Severity", "Hour", "count")
    return out.withColumn("relative", F.round("relative", 6))


@register("w05_union_reports")
def w05(spark, base_dir):
    raw = inc.raw_incidents(spark, base_dir)
    return windows.union_reports(validate.null_report(raw), profile.missing_report(raw))


# ---- reports ---------------------------------------------------------------------

@register("r01_pipeline_quality")
def r01(spark, base_dir):
    return reports.pipeline_quality(_lineage(spark, base_dir))


@register("r01_pipeline_quality_measured")
def r01m(spark, base_dir):
    return reports.pipeline_quality(_lineage(spark, base_dir), measure=True)


@register("r02_model_performance")
def r02(spark, base_dir):
    p = transform.binary_label(_preds(spark, base_dir))
    p = p.withColumn("pred_bin", F.when(F.col("pred_a") >= 2, 1.0).otherwise(0.0))
    return reports.model_performance(p, MODELS, {"rule_binary": ("pred_bin", "score")})


REGISTRY["r03_business_insights"] = REGISTRY["a04_prediction_insights"]
REGISTRY["a06_best_by"] = REGISTRY["m14_best_model"]


# ---- ML feature pipeline ---------------------------------------------------------------

def _filled(spark, base_dir):
    from sevlens.plans.pipeline import ConstantFill, IncidentFeatures
    return ConstantFill().transform(IncidentFeatures().transform(inc.enriched_incidents(spark, base_dir)))


def _indexed(spark, base_dir):
    from sevlens.plans.pipeline import string_indexers
    df = _filled(spark, base_dir)
    return string_indexers().fit(df).transform(df)


@register("f01_median_impute")
def f01(spark, base_dir):
    from sevlens.plans.pipeline import IMPUTE_COLUMNS, IncidentFeatures, median_imputer
    df = IncidentFeatures().transform(inc.enriched_incidents(spark, base_dir))
    return median_imputer().fit(df).transform(df).select("ID", *[f"{c}_imp" for c in IMPUTE_COLUMNS])


@register("f02_constant_fill")
def f02(spark, base_dir):
    from sevlens.plans.pipeline import CATEGORY_FILL
    return _filled(spark, base_dir).select("ID", *CATEGORY_FILL)


@register("f03_string_index")
def f03(spark, base_dir):
    from sevlens.plans.pipeline import INDEX_COLUMNS
    return _indexed(spark, base_dir).select("ID", *[f"{c}_idx" for c in INDEX_COLUMNS])


@register("f04_one_hot")
def f04(spark, base_dir):
    from pyspark.ml.functions import vector_to_array
    from sevlens.plans.pipeline import ONE_HOT_COLUMNS, one_hot
    df = _indexed(spark, base_dir)
    return one_hot().fit(df).transform(df).select("ID", *[vector_to_array(f"{c}_ohe").alias(f"{c}_ohe")
                                            for c in ONE_HOT_COLUMNS])


def _plain_assembled(spark, base_dir):
    from sevlens.plans.pipeline import BOOL_COLUMNS, ENGINEERED_COLUMNS, CastColumns, CleanNumeric, assembler
    cols = list(BOOL_COLUMNS) + list(ENGINEERED_COLUMNS)
    df = CastColumns(inputCols=list(BOOL_COLUMNS)).transform(_filled(spark, base_dir))
    df = CleanNumeric(inputCols=cols).transform(df)
    return assembler(cols).transform(df)


@register("f05_assemble")
def f05(spark, base_dir):
    from pyspark.ml.functions import vector_to_array
    return _plain_assembled(spark, base_dir).select("ID", vector_to_array("raw_features").alias("raw_features"))


@register("f06_standard_scale")
def f06(spark, base_dir):
    from pyspark.ml.functions import vector_to_array
    from sevlens.plans.pipeline import ENGINEERED_COLUMNS, assembler, scaler
    df = assembler(list(ENGINEERED_COLUMNS), "eng").transform(featured(spark, base_dir))
    scaled = scaler("eng", "scaled").fit(df).transform(df)
    return scaled.select("ID", F.transform(vector_to_array("scaled"), lambda x: F.round(x, 6)).alias("scaled"))


@register("f07_pipeline_features")
def f07(spark, base_dir):
    from pyspark.ml.functions import vector_to_array
    _, frames = models.ready(spark, base_dir)
    return _union_all([f.select("ID", "split", F.transform(vector_to_array("features"),
                                                          lambda x: F.round(x, 6)).alias("features"))
                       for f in frames.values()])


@register("f08_pipeline_saved_and_loaded")
def f08(spark, base_dir):
    """The fitted pipeline saved, loaded by its path alone and applied to the incidents."""
    from pyspark.ml.functions import vector_to_array

    from sevlens.plans.pipeline import load_pipeline, save_model
    pipe, _ = models.ready(spark, base_dir)
    path = _scratch(spark, "saved-pipeline")
    save_model(pipe, path)
    rows = transform.binary_label(transform.label_from_severity(inc.enriched_incidents(spark, base_dir)))
    out = load_pipeline(path).transform(sampling.assign_split(rows))
    return out.select("ID", "split", F.transform(vector_to_array("features"), lambda x: F.round(x, 6)).alias("features"))


@register("e06_model_saved_and_loaded")
def e06(spark, base_dir):
    """A fitted model saved, loaded and scoring the test split, next to the one in memory."""
    from pyspark.ml.classification import LogisticRegressionModel

    from sevlens.plans.pipeline import load_model, save_model
    _, frames = models.ready(spark, base_dir)
    model, _ = models.fitted(spark, base_dir, "lr")
    path = _scratch(spark, "saved-model")
    save_model(model, path)
    rows = frames["test"].select("ID", "features")
    loaded = load_model(path, LogisticRegressionModel).transform(rows).select("ID", F.col("prediction").alias("loaded"))
    both = model.transform(rows).select("ID", "prediction").join(loaded, "ID")
    return both.select("ID", (F.col("prediction") == F.col("loaded")).alias("same_prediction"), F.col("prediction").isin(0.0, 1.0, 2.0, 3.0).alias("known_class"))


@register("f09_clean_numeric")
def f09(spark, base_dir):
    from sevlens.plans.pipeline import CleanNumeric
    cols = list(inc.NUMERIC_COLUMNS) + ["Junction"]
    df = inc.raw_incidents(spark, base_dir, state=False).select("ID", *cols)
    return CleanNumeric(inputCols=cols).transform(df)


@register("f10_slot_names")
def f10(spark, base_dir):
    _, frames = models.ready(spark, base_dir)
    names = models.feature_names(frames)
    return spark.createDataFrame(list(enumerate(names)), "slot int, name string")


# ---- MLlib models (value checks live in tests/; rows-only here) ---------------------------

def _test_predictions(spark, base_dir, name, label="label"):
    _, frames = models.ready(spark, base_dir)
    model, _ = models.fitted(spark, base_dir, name)
    return model.transform(frames["test"]).select("ID", label, "prediction")


@register("e01_logistic_regression")
def e01(spark, base_dir):
    return _test_predictions(spark, base_dir, "lr")


@register("e02_random_forest")
def e02(spark, base_dir):
    return _test_predictions(spark, base_dir, "rf")


@register("e03_gbt_binary")
def e03(spark, base_dir):
    return _test_predictions(spark, base_dir, "gbt", "binary_label")


@register("e04_decision_tree")
def e04(spark, base_dir):
    model, _ = models.fitted(spark, base_dir, "dt")
    return _test_predictions(spark, base_dir, "dt").withColumns(
        {"tree_depth": F.lit(model.depth), "tree_nodes": F.lit(model.numNodes)})


@register("e01_e04_model_facts")
def e01_facts(spark, base_dir):
    _, frames = models.ready(spark, base_dir)
    return models.model_facts(frames, {n: (models.fitted(spark, base_dir, n)[0], "binary_label" if n == "gbt" else "label")
                                       for n in ("lr", "rf", "gbt", "dt")})


def _tuned(spark, base_dir):
    return models.memo(spark, base_dir, "tuned", lambda: models.tuned_forest(models.ready(spark, base_dir)[1]))


@register("e05_tune_rf")
def e05(spark, base_dir):
    return _tuned(spark, base_dir)[2]


@register("e05_search_facts")
def e05_facts(spark, base_dir):
    """The cells of the search with the rows that each trained and was judged on; one of them is the best."""
    best = F.max_by(F.struct("numTrees", "maxDepth"), F.struct("f1", -F.col("numTrees"), -F.col("maxDepth"))).over(Window.partitionBy())
    table = _tuned(spark, base_dir)[2].withColumn("__first", best)
    agrees = (F.struct("numTrees", "maxDepth") == F.col("__first")) == F.col("best")
    return table.select("numTrees", "maxDepth", "train_rows", "valid_rows", agrees.alias("best_by_f1"),
                        (F.col("accuracy").between(0, 1) & F.col("f1").between(0, 1)).alias("metrics_in_range"))


@register("e05_tuned_on_validation")
def e05_valid(spark, base_dir):
    """The tuned forest, its parameters and its metrics on the whole validation split."""
    _, params, _, m = _tuned(spark, base_dir)
    return spark.createDataFrame([("RF_MLlib_Tuned", *params.values(), m["accuracy"], m["f1"])],
                                 "Model string, numTrees int, maxDepth int, Val_Accuracy double, Val_F1 double")


@register("e07_feature_importances")
def e07(spark, base_dir):
    _, frames = models.ready(spark, base_dir)
    model, _ = models.fitted(spark, base_dir, "rf")
    return models.importances(model, models.feature_names(frames), 20)


REGISTRY["r05_importance_table"] = REGISTRY["e07_feature_importances"]


@register("e08_sample_vs_full")
def e08(spark, base_dir):
    _, frames = models.ready(spark, base_dir)
    full = {k: models.fitted(spark, base_dir, v) for k, v in (("LR", "lr"), ("RF", "rf"), ("GBT", "gbt"))}
    return models.sample_vs_full(frames["train"], frames["valid"], full_fits=full)


def _summary_rows(spark, base_dir):
    _, frames = models.ready(spark, base_dir)
    titles = {"lr": "LR", "rf": "RF", "dt": "DT", "gbt": "GBT_Binary"}
    fits = {n: (models.fitted(spark, base_dir, n)[0], "binary_label" if n == "gbt" else "label") for n in titles}
    rows = []
    # the test rows are scored by all models in one pass; what is held of them is labels, predictions and the binary probability
    with sampling.cached(models.score_all(frames["test"], fits, probability=["gbt"])) as preds:
        for name, title in titles.items():
            m = models.evaluate_model(preds, f"{name}_prediction", fits[name][1])
            auc = models.binary_auc(preds, probability="gbt_probability") if name == "gbt" else None
            rows.append({"Model": title, "Train_Time_s": models.fitted(spark, base_dir, name)[1], "Test_Accuracy": m["accuracy"],
                         "Test_F1": m["f1"], "Test_Precision": m["precision"], "Test_Recall": m["recall"],
                         "AUC_ROC": auc})
    return rows


@register("e09_model_summary")
def e09(spark, base_dir):
    return models.model_summary(spark, _summary_rows(spark, base_dir))


@register("r04_scalability")
def r04(spark, base_dir):
    from sevlens.plans import scaling
    _, frames = models.ready(spark, base_dir)
    train = frames["train"]
    return reports.scalability(scaling.strong_scaling(train), scaling.weak_scaling(train))


@register("r06_ci_table")
def r06(spark, base_dir):
    _, frames = models.ready(spark, base_dir)
    scored = frames["test"].select("ID", "label", "features")
    for name in ("lr", "rf", "dt"):
        model, _ = models.fitted(spark, base_dir, name)
        scored = models.score(model, scored, name).drop(f"{name}_probability", f"{name}_raw")
    return evaluate.bootstrap_ci(scored, {"LR_MLlib": "lr_prediction", "RF_MLlib": "rf_prediction",
                                          "DT_MLlib": "dt_prediction"}, replicates=500, seed=42)
