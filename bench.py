"""Headline timings of the incident workload.

Runs the reference's stages on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}.

Each stage is forced with a ``noop`` write (full execution, nothing collected)
or an action that returns a few rows.  Model fits use the reference's
hyper-parameters on the training split.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sevlens.operators import aggregate, evaluate, profile, sampling, validate  # noqa: E402
from sevlens.plans import incidents as inc  # noqa: E402
from sevlens.plans import models  # noqa: E402
from sevlens.plans import queries as Q  # noqa: E402
from sevlens.session import build_session, scratch_path  # noqa: E402
from sevlens.sources import files  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = build_session(f"local[{cpus}]", max(8, 2 * cpus), app="sevlens-bench",
                          extra={"spark.driver.memory": "16g"})
    timings: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        out = fn()
        timings[name] = round(time.time() - t0, 3)
        return out

    # warm-up: JVM start, parquet footers (not timed)
    inc.state_lookup(spark, sf_dir).count()

    raw = inc.raw_incidents(spark, sf_dir)
    csv_path = files.write_csv(raw, scratch_path(spark, "bench-incidents-csv"))   # setup: the raw CSV

    timed("ingest_csv", lambda: run(files.read_csv(spark, csv_path, raw.schema)))
    timed("validation", lambda: [validate.ingest_report(raw).collect(),       # one scan, all checks
                                 profile.class_distribution(raw).collect()])
    timed("repartition_by_state", lambda: run(sampling.repartition_by(raw, 10, "State")))
    enriched = inc.enriched_incidents(spark, sf_dir)
    timed("broadcast_enrich", lambda: run(enriched))
    timed("parquet_partitioned_write",
          lambda: files.write_partitioned(enriched, scratch_path(spark, "bench-by-state"), "State"))
    timed("profile_eda", lambda: [profile.missing_report(enriched).collect(),
                                  profile.describe_numeric(raw, inc.NUMERIC_COLUMNS).collect(),
                                  profile.quantiles(raw, inc.NUMERIC_COLUMNS).collect(),
                                  profile.top_k(raw, "State").collect()])
    timed("flagship_region_hour", lambda: Q.flagship(spark, sf_dir).collect())

    _, frames = timed("pipeline_fit_transform", lambda: _ready(spark, sf_dir))
    train, test = frames["train"], frames["test"]
    fitted = {}
    for name, fit in (("lr", models.fit_lr), ("rf", models.fit_rf), ("gbt", models.fit_gbt),
                      ("dt", models.fit_dt)):
        fitted[name] = timed(f"train_{name}", lambda fit=fit: fit(train))

    def score_and_evaluate():
        scored = test.select("ID", "label", "binary_label", "features", "Start_Time", "State")
        for name in ("lr", "rf", "dt"):
            scored = models.score(fitted[name], scored, name).drop(f"{name}_raw", f"{name}_probability")
        scored = models.score(fitted["gbt"], scored, "gbt").drop("gbt_raw")
        scored = scored.persist()
        mc = {"LR": "lr_prediction", "RF": "rf_prediction", "DT": "dt_prediction"}
        evaluate.evaluate_all(scored, mc).collect()
        evaluate.confusion(scored, "label", "rf_prediction").collect()
        evaluate.class_report(scored, "label", "rf_prediction").collect()
        models.binary_auc(scored.withColumnRenamed("gbt_probability", "probability"))
        evaluate.mcnemar(scored, "rf_prediction", "lr_prediction").collect()
        evaluate.bootstrap_ci(scored, mc, replicates=500).collect()
        run(aggregate.prediction_insights(scored, "label", "rf_prediction"))
        scored.unpersist()
    timed("score_and_evaluate", score_and_evaluate)

    preds = inc.rule_predictions(raw)
    timed("roc_pr_curves", lambda: [
        evaluate.roc_auc(evaluate.score_groups(preds, Q.CLASS_SCORES, "label")).collect(),
        run(evaluate.pr_curve(evaluate.score_groups(preds, Q.CLASS_SCORES, "label")))])

    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "incident_workload_total", "value": total, "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": cpus,
                      "rows": raw.count()}))
    spark.stop()


def _ready(spark, sf_dir):
    pipe, frames = models.model_ready(spark, sf_dir)
    frames["train"].count()   # materialise the persisted training split inside the timing
    return pipe, frames


if __name__ == "__main__":
    main()
