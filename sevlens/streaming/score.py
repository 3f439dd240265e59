"""Scoring incidents as they arrive (Structured Streaming).

The engineered features and a fitted ``PipelineModel`` are stateless row
transforms, so the batch plan runs unchanged on a streaming source: events are
read with ``readStream`` (schema fixed up front, bounded files per trigger),
joined stream-static to the customer / nation / lookup dimensions, transformed
by the saved pipeline and classifier, and written with a checkpoint in the
shared folder so a restarted query resumes exactly where it stopped.  No state
store, watermark or window is needed: nothing is aggregated across events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sevlens.operators import transform
from sevlens.operators.enrich import enrich
from sevlens.plans import incidents as inc
from sevlens.session import scratch_path


def incident_stream(spark: SparkSession, base_dir: str, events_dir: str,
                    max_files_per_trigger: int = 1) -> DataFrame:
    """Streaming enriched incidents from event files arriving in the folder ``events_dir``.

    The schema is the one of ``base_dir``'s events table (no inference on the stream).
    """
    path = events_dir
    schema = inc.table(spark, base_dir, "events").schema
    events = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(path))
    raw = inc.raw_incidents(spark, base_dir, events=events)
    return enrich(raw, inc.state_lookup(spark, base_dir), "State", "left")


def scored_stream(stream: DataFrame, pipeline_model, classifier) -> DataFrame:
    """Apply the fitted feature pipeline and classifier to a streaming frame."""
    labelled = transform.binary_label(transform.label_from_severity(stream))
    scored = classifier.transform(pipeline_model.transform(labelled))
    return scored.select("ID", "Start_Time", "State", "label",
                         F.col("prediction").alias("predicted_label"))


def start_scoring(spark: SparkSession, scored: DataFrame, output_path: str,
                  checkpoint: str | None = None, once: bool = True) -> StreamingQuery:
    """Append scored rows as Parquet; the checkpoint lives under the shared checkpoint folder."""
    writer = (scored.writeStream.format("parquet").outputMode("append")
              .option("path", output_path)
              .option("checkpointLocation", checkpoint or scratch_path(spark, "scoring-checkpoint")))
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")
    return writer.start()
