"""Report tables: efficiency, cost, scalability, lineage, model performance."""

import pytest
from pyspark.sql import functions as F

from sevlens.operators import reports
from sevlens.plans import incidents as inc
from sevlens.session import scratch_path
from sevlens.sources import files


def test_efficiency_and_cost(spark):
    # literal timings of a strong and a weak run (unit test of the formulas only)
    strong = spark.createDataFrame([(2, 4.0), (4, 2.5), (8, 2.0)], "partitions int, time_s double")
    weak = spark.createDataFrame([(2, 0.05, 1.0), (4, 0.1, 2.0)],
                                 "partitions int, data_fraction double, time_s double")
    rows = {(r.Scaling_Type, r.partitions): r for r in reports.scalability(strong, weak).collect()}
    assert rows[("Strong", 2)].Efficiency == 1.0
    assert rows[("Strong", 4)].Efficiency == pytest.approx(4.0 / (2.5 * 4 / 2), abs=1e-4)
    assert rows[("Strong", 8)].Speedup == 2.0
    assert rows[("Weak", 4)].Efficiency == 0.5 and rows[("Weak", 4)].data_fraction == 0.1
    assert rows[("Strong", 8)].Estimated_Cost_USD == pytest.approx(2.0 / 3600 * 8 * 0.10, abs=1e-6)
    assert rows[("Strong", 2)].data_fraction is None


def test_lineage_is_observed_saved_and_read_back(spark, sf_small):
    raw, at = inc.raw_incidents(spark, sf_small), {x: scratch_path(spark, x) for x in ("raw", "state", "saved")}
    saved = reports.run_stages(spark, [
        lambda: reports.Stage("Ingestion", "events", "Parquet", raw, at["raw"]),
        lambda: reports.Stage("Validation", "incidents", "DF", spark.read.parquet(at["raw"])),
        lambda: reports.Stage("Enrichment", "lookup", "DF", inc.enriched_incidents(spark, sf_small), at["state"], "State")], at["saved"])
    lin, n = reports.lineage(saved).orderBy("step").collect(), raw.count()
    assert [r.rows for r in lin] == [n] * 3 and [r.step for r in lin] == [1, 2, 3]
    cells = raw.select(sum(F.count_if(F.col(c).isNull()) for c in raw.columns).alias("n")).first().n
    assert lin[0].null_rate_pct == lin[1].null_rate_pct == pytest.approx(100 * cells / n / len(raw.columns), abs=1e-4)
    q = {r.Stage: r for r in reports.pipeline_quality(saved, measure=True).collect()}
    assert q["Ingestion"].Storage_MB > 0 and q["Validation"].Storage_MB is None
    assert q["Enrichment"].Partition_Count == raw.select("State").distinct().count()
    assert all(r.Processing_Time_s >= 0 for r in q.values())
    assert reports.lineage(files.read_metrics(spark, at["saved"], reports.LINEAGE)).count() == 3


def test_model_performance_union(spark):
    rows = [(0.0, 0.0, 1.0, 0.0, 0.2), (1.0, 1.0, 1.0, 0.0, 0.1), (1.0, 0.0, 0.0, 1.0, 0.9)]
    p = spark.createDataFrame(rows, "label double, pa double, pb double, binary_label double, score double")
    out = {r.Model: r for r in reports.model_performance(
        p.withColumn("pbin", p.score * 0 + 1.0), {"a": "pa", "b": "pb"}, {"bin": ("pbin", "score")}).collect()}
    assert out["a"].Task == "Multiclass" and out["a"].AUC_ROC is None
    assert out["bin"].Task == "Binary" and out["bin"].AUC_ROC == 1.0 and out["bin"].Test_F1 is None
