"""End-to-end incident workload with the library, stage by stage.

    python examples/end_to_end.py [tables_dir] [output_dir]

1. ingest: incidents from the input tables, validation report, enrichment,
   partitioned Parquet, lineage;
2. features: EDA tables, split by id hash, pipeline fitted on the training split;
3. training: LR / RF / GBT / DT with the reference's parameters;
4. evaluation: metrics, confusion, class report, AUC, bootstrap CIs, McNemar,
   dashboard tables as CSV.

Outputs go under ``output_dir`` (default: a fresh folder under the session's
shared checkpoint folder).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sevlens.operators import evaluate, profile, reports, validate  # noqa: E402
from sevlens.plans import incidents as inc  # noqa: E402
from sevlens.plans import models  # noqa: E402
from sevlens.plans.pipeline import save_model  # noqa: E402
from sevlens.session import build_session, scratch_path  # noqa: E402
from sevlens.sources import files  # noqa: E402


def main() -> None:
    base = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session("local[*]", 8, app="sevlens-example")
    out = sys.argv[2] if len(sys.argv) > 2 else scratch_path(spark, "example")

    # 1. ingest, validate, enrich, store
    raw = inc.raw_incidents(spark, base)
    validate.ingest_report(raw).show(truncate=False)
    enriched = inc.enriched_incidents(spark, base)
    out_df, seen = files.observed(enriched)
    files.write_partitioned(out_df, f"{out}/incidents_by_state", "State")
    files.verify_write(spark, f"{out}/incidents_by_state", enriched.schema, seen.get["rows"], "State").show()

    # 2. EDA and the model-ready table (pipeline fitted on the training split)
    profile.missing_report(enriched).show()
    profile.top_k(raw, "Weather_Condition").show()
    pipe, frames = models.model_ready(spark, base)
    save_model(pipe, f"{out}/models/preprocessing")

    # 3. training
    fitted = {name: fit(frames["train"]) for name, fit in
              (("lr", models.fit_lr), ("rf", models.fit_rf), ("dt", models.fit_dt), ("gbt", models.fit_gbt))}
    for name, model in fitted.items():
        save_model(model, f"{out}/models/{name}")

    # 4. evaluation on the test split, all on DataFrames
    scored = frames["test"].select("ID", "label", "binary_label", "features", "Start_Time", "State")
    for name in ("lr", "rf", "dt"):
        scored = models.score(fitted[name], scored, name).drop(f"{name}_raw", f"{name}_probability")
    scored = models.score(fitted["gbt"], scored, "gbt").drop("gbt_raw")
    multiclass = {"LR_MLlib": "lr_prediction", "RF_MLlib": "rf_prediction", "DT_MLlib": "dt_prediction"}
    metrics = evaluate.evaluate_all(scored, multiclass)
    metrics.show()
    evaluate.class_report(scored, "label", "rf_prediction").show()
    evaluate.confusion_norm(scored, "label", "rf_prediction").show()
    print("GBT AUC", models.binary_auc(scored.withColumnRenamed("gbt_probability", "probability")))
    ci = evaluate.bootstrap_ci(scored, multiclass)
    ci.show()
    evaluate.mcnemar(scored, "rf_prediction", "lr_prediction").show()

    files.export_csv(metrics, f"{out}/dashboards/model_performance")
    files.export_csv(ci, f"{out}/dashboards/bootstrap_confidence_intervals")
    files.export_csv(reports.business_insights(scored, "label", "rf_prediction"),
                     f"{out}/dashboards/business_insights")
    print("outputs under", out)
    spark.stop()


if __name__ == "__main__":
    main()
