"""The saved pipeline and a classifier score a streaming source unchanged."""

from sevlens.plans import incidents as inc
from sevlens.plans import models
from sevlens.session import scratch_path
from sevlens.streaming import score


def test_stream_scoring_matches_batch(spark, sf_small):
    pipe, frames = models.model_ready(spark, sf_small)
    clf = models.fit_dt(frames["train"], maxDepth=3)
    events_dir = scratch_path(spark, "t-stream-in")
    inc.table(spark, sf_small, "events").repartition(3).write.parquet(events_dir)   # three arriving files
    stream = score.incident_stream(spark, sf_small, events_dir)
    assert stream.isStreaming
    out = scratch_path(spark, "t-stream-out")
    q = score.start_scoring(spark, score.scored_stream(stream, pipe, clf), out)
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    assert got.count() == inc.raw_incidents(spark, sf_small).count()
    batch = clf.transform(frames["test"]).select("ID", "prediction")
    joined = got.join(batch, "ID")
    assert joined.where("predicted_label <> prediction").count() == 0


def test_restart_resumes_from_checkpoint(spark, sf_small):
    from pyspark.sql import functions as F
    pipe, frames = models.model_ready(spark, sf_small)
    clf = models.fit_dt(frames["train"], maxDepth=2)
    events = inc.table(spark, sf_small, "events")
    events_dir = scratch_path(spark, "t-resume-in")
    out, ckpt = scratch_path(spark, "t-resume-out"), scratch_path(spark, "t-resume-ckpt")
    events.where(F.col("event_id") % 2 == 0).write.parquet(f"{events_dir}/batch=0")
    first = score.start_scoring(spark, score.scored_stream(
        score.incident_stream(spark, sf_small, events_dir), pipe, clf), out, ckpt)
    first.awaitTermination(300)
    n_first = spark.read.parquet(out).count()
    events.where(F.col("event_id") % 2 == 1).write.parquet(f"{events_dir}/batch=1")   # new files arrive
    second = score.start_scoring(spark, score.scored_stream(
        score.incident_stream(spark, sf_small, events_dir), pipe, clf), out, ckpt)
    second.awaitTermination(300)
    got = spark.read.parquet(out)
    assert n_first == events.where(F.col("event_id") % 2 == 0).count()
    assert got.count() == events.count() and got.select("ID").distinct().count() == events.count()
