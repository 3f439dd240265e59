"""Feature pipeline and models: fit on train only, persistence, unseen values, NaN safety."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F

from sevlens.operators import sampling
from sevlens.plans import incidents as inc
from sevlens.plans import models
from sevlens.plans.pipeline import build_pipeline, slot_names
from sevlens.session import scratch_path


@pytest.fixture(scope="module")
def ready(spark, sf_small):
    return models.model_ready(spark, sf_small)


def test_vector_size_and_no_nan(ready):
    _, frames = ready
    train = frames["train"]
    size = train.select("features").first()[0].size
    assert size == len(slot_names(train, "raw_features")) >= 45
    arr = train.select(F.explode(vector_to_array("features")).alias("x"))
    assert arr.where(F.isnan("x") | F.col("x").isNull()).count() == 0


def test_label_range(ready):
    _, frames = ready
    r = frames["train"].agg(F.min("label"), F.max("label")).first()
    assert r[0] >= 0.0 and r[1] <= 3.0


def test_splits_disjoint_and_complete(ready, spark, sf_small):
    _, frames = ready
    total = inc.raw_incidents(spark, sf_small).count()
    assert sum(f.count() for f in frames.values()) == total
    ids = [set(r.ID for r in f.select("ID").collect()) for f in frames.values()]
    assert not (ids[0] & ids[1]) and not (ids[0] & ids[2]) and not (ids[1] & ids[2])


def test_save_load_same_predictions(ready, spark, sf_small):
    pipe, frames = ready
    path = scratch_path(spark, "pipeline-model")
    pipe.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    raw = inc.enriched_incidents(spark, sf_small).limit(50)
    a = pipe.transform(raw).select("ID", vector_to_array("features").alias("f")).orderBy("ID").collect()
    b = loaded.transform(raw).select("ID", vector_to_array("features").alias("f")).orderBy("ID").collect()
    assert a == b
    model = models.fit_dt(frames["train"])
    mpath = scratch_path(spark, "dt-model")
    model.write().overwrite().save(mpath)
    from pyspark.ml.classification import DecisionTreeClassificationModel
    again = DecisionTreeClassificationModel.load(mpath)
    p1 = model.transform(frames["test"]).select("prediction").collect()
    p2 = again.transform(frames["test"]).select("prediction").collect()
    assert p1 == p2


def test_unseen_category_and_bad_numbers(ready, spark, sf_small):
    pipe, _ = ready
    row = inc.enriched_incidents(spark, sf_small).limit(1)
    odd = row.withColumns({"Weather_Condition": F.lit("Volcanic ash"), "Region": F.lit("ATLANTIS"),
                           "Temperature_F": F.lit(float("nan")), "Wind_Speed_mph": F.lit(float("inf")),
                           "Junction": F.lit(None).cast("boolean")})
    out = pipe.transform(odd)
    feats = out.select(vector_to_array("raw_features")).first()[0]
    assert all(x == x and abs(x) != float("inf") for x in feats)      # no NaN / Inf reaches the vector
    names = slot_names(out, "raw_features")
    region = [i for i, n in enumerate(names) if n.startswith("Region_ohe")]
    assert all(feats[i] == 0.0 for i in region)                        # unseen -> all-zero one-hot
    labels = [s for s in pipe.stages if type(s).__name__ == "StringIndexerModel"][0].labelsArray
    weather = labels[1]
    assert out.select("Weather_Condition_idx").first()[0] == float(len(weather))   # 'keep' bucket


def test_lr_dt_train_and_score(ready):
    _, frames = ready
    lr = models.fit_lr(frames["train"], maxIter=20)
    m = models.evaluate_model(lr.transform(frames["test"]))
    assert 0.0 <= m["accuracy"] <= 1.0
    dt_model = models.fit_dt(frames["train"], maxDepth=4)
    imp = models.importances(dt_model, slot_names(frames["train"], "raw_features"), 5).collect()
    assert [r.Rank for r in imp] == [1, 2, 3, 4, 5]
    assert imp[0].Importance >= imp[-1].Importance


def test_gbt_binary_auc(ready):
    _, frames = ready
    gbt = models.fit_gbt(frames["train"], maxIter=5)
    auc = models.binary_auc(gbt.transform(frames["test"]))
    assert 0.0 <= auc <= 1.0


def test_pipeline_fits_on_given_rows_only(spark, sf_small):
    df = inc.enriched_incidents(spark, sf_small).withColumn("Severity", F.col("Severity"))
    small = df.where(F.col("ID") < 10)
    model = build_pipeline().fit(small)
    # the median imputer surrogate comes from the ten rows it was fitted on
    imputer = [s for s in model.stages if type(s).__name__ == "ImputerModel"][0]
    surrogate = imputer.surrogateDF.first()["Distance_mi"]
    vals = sorted(r.Distance_mi for r in small.select("Distance_mi").collect())
    assert surrogate in vals


def test_indexer_ties_are_alphabetical_and_unseen_gets_last_index(spark):
    from sevlens.plans.pipeline import string_indexers
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "w string")
    model = string_indexers(["w"]).fit(df)
    assert model.labelsArray[0] == ["c", "a", "b"]
    unseen = spark.createDataFrame([("zzz",)], "w string")
    assert model.transform(unseen).first().w_idx == 3.0


def test_search_returns_every_cell_and_the_best(ready):
    _, frames = ready
    model, params, table, valid = models.tuned_forest(frames, grid={"numTrees": (2, 4), "maxDepth": (2, 3)}, fraction=0.9)
    rows = table.collect()
    assert [(r.numTrees, r.maxDepth) for r in rows] == [(2, 2), (2, 3), (4, 2), (4, 3)]
    best = max(rows, key=lambda r: r.f1)
    assert [r.best for r in rows].count(True) == 1 and best.f1 == next(r.f1 for r in rows if r.best)
    assert params == {"numTrees": model.getNumTrees, "maxDepth": model.getOrDefault("maxDepth")} and 0 <= valid["f1"] <= 1
    again = models.tune_rf(frames["train"].repartition(5), {"numTrees": (2,), "maxDepth": (2,)}, 0.9)[2].first()
    assert (again.train_rows, again.valid_rows) == (rows[0].train_rows, rows[0].valid_rows)


def test_search_takes_every_row_of_the_training_split(ready, spark):
    """No sample of the split: each of its rows trains a cell or judges it."""
    vector = Vectors.dense([0.0, 1.0])
    rows = spark.createDataFrame([(i, float(i % 2), vector if i % 2 else Vectors.dense([1.0, 0.0])) for i in range(400)], ["ID", "label", "features"])
    r = models.tune_rf(rows, {"numTrees": (2,), "maxDepth": (2,)})[2].first()
    assert r.train_rows + r.valid_rows == 400 and 270 < r.train_rows < 370
    _, frames = ready
    r = models.tuned_forest(frames, grid={"numTrees": (2,), "maxDepth": (2,)})[2].first()
    assert r.train_rows + r.valid_rows == frames["train"].count()


def test_search_trains_on_partitions_of_its_own_sample(ready, monkeypatch):
    """The sample's rows, not the training split's, say how many partitions send statistics (F1, F8)."""
    _, frames = ready
    seen, fit = [], models.RandomForestClassifier.fit

    def spy(self, df, *args):
        seen.append(df.rdd.getNumPartitions())
        return fit(self, df, *args)
    monkeypatch.setattr(models.RandomForestClassifier, "fit", spy)
    models.tune_rf(frames["train"].repartition(40), {"numTrees": (2,), "maxDepth": (2,)}, 0.9)
    assert seen == [sampling.MIN_TRAIN_PARTITIONS]


def _counted_rows(spark, n=60):
    """(frame of n rows whose feature vectors count how often they are built, that counter, the same rows without it)."""
    built = spark.sparkContext.accumulator(0)

    @F.udf(VectorUDT())
    def vector(i):
        built.add(1)
        return Vectors.dense([float(i % 7), float(i % 2)])
    plain = spark.createDataFrame([(i, float(i % 3), float(i % 2), Vectors.dense([float(i % 7), float(i % 2)])) for i in range(n)],
                                  ["ID", "label", "binary_label", "features"])
    rows = spark.createDataFrame([(i, float(i % 3), float(i % 2)) for i in range(n)], ["ID", "label", "binary_label"])
    return rows.withColumn("features", vector("ID")), built, plain


@pytest.fixture
def small_fits(monkeypatch):
    monkeypatch.setitem(models.RF_PARAMS, "numTrees", 2)
    monkeypatch.setitem(models.GBT_PARAMS, "maxIter", 1)


def test_facts_build_each_row_once_for_all_models(spark, small_fits):
    """The train and test rows run through the feature stages once and not once a model."""
    rows, built, plain = _counted_rows(spark)
    fits = {"lr": (models.fit_lr(plain), "label"), "dt": (models.fit_dt(plain), "label"), "gbt": (models.fit_gbt(plain), "binary_label")}
    facts = {r.model: r for r in models.model_facts({"train": rows, "test": rows}, fits).collect()}
    assert built.value == 2 * 60
    assert [(r.train_rows, r.test_rows) for r in facts.values()] == [(60, 60)] * 3
    assert (facts["lr"].classes, facts["gbt"].classes, facts["lr"].majority_share) == (3, 2, 0.333333)
    right = plain.join(models.score(fits["dt"][0], plain).select("ID", "prediction"), "ID").where("label = prediction").count()
    assert facts["dt"].not_below_majority == (right >= 20)


def test_sample_and_full_models_share_one_pass_over_validation(spark, small_fits):
    """Six models score the validation rows in one pass (F2)."""
    rows, built, plain = _counted_rows(spark)
    table = models.sample_vs_full(plain, rows, n=40).collect()
    assert built.value == 60
    assert [(r.Model, r.Sample_Size) for r in table] == [(m, s) for m in ("LR", "RF", "GBT") for s in ("sample_40", "full")]
    want = models.evaluate_model(models.fit_gbt(plain).transform(plain), "prediction", "binary_label")
    assert (table[5].Val_Accuracy, table[5].Val_F1) == (want["accuracy"], want["f1"])


def test_summary_scores_the_test_rows_once(spark, small_fits, monkeypatch):
    """Four models, their metrics and the AUC read one scoring pass over the test rows (F1)."""
    from sevlens.plans import queries
    rows, built, plain = _counted_rows(spark)
    fits = {"lr": models.fit_lr(plain), "rf": models.fit_rf(plain), "dt": models.fit_dt(plain), "gbt": models.fit_gbt(plain)}
    monkeypatch.setattr(models, "ready", lambda *_: (None, {"test": rows}))
    monkeypatch.setattr(models, "fitted", lambda s, d, name: (fits[name], 1.5))
    got = {r["Model"]: r for r in queries._summary_rows(spark, "")}
    assert built.value == 60
    for title, name, label in (("LR", "lr", "label"), ("RF", "rf", "label"), ("DT", "dt", "label"), ("GBT_Binary", "gbt", "binary_label")):
        want = models.evaluate_model(fits[name].transform(plain), "prediction", label)
        assert (got[title]["Test_Accuracy"], got[title]["Test_F1"], got[title]["Train_Time_s"]) == (want["accuracy"], want["f1"], 1.5)
    assert got["GBT_Binary"]["AUC_ROC"] == models.binary_auc(fits["gbt"].transform(plain)) and got["LR"]["AUC_ROC"] is None


def test_other_splits_stay_out_of_the_feature_stages(spark, sf_small, ready):
    """A split's rows alone are dealt and assembled: its filter lies below the exchange by id."""
    _, frames = ready
    plan = frames["test"]._jdf.queryExecution().optimizedPlan().toString()
    dealt = plan.index("RepartitionByExpression")
    assert "Filter" in plan[dealt:] and "Filter" not in plan[:dealt]


def test_training_rows_are_held_before_scaling(ready):
    """The persisted rows have the assembled vector alone; the scaled one follows as it is read."""
    pipe, frames = ready
    held = [line for line in frames["train"]._jdf.queryExecution().withCachedData().toString().splitlines() if "InMemoryRelation" in line and "raw_features#" in line]
    assert held and not any(" features#" in line for line in held)
    row = frames["train"].orderBy("ID").first()
    scale = pipe.stages[-1]
    sd = scale.std.toArray()
    want = [(x - m) / s if s else 0.0 for x, m, s in zip(row.raw_features.toArray(), scale.mean.toArray(), sd)]
    assert max(abs(a - b) for a, b in zip(row.features.toArray(), want)) < 1e-9
