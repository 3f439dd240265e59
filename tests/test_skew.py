"""A key holding a third of all rows: shuffle paths give the same results as broadcast ones."""

from pyspark.sql import functions as F

from sevlens.operators import aggregate, enrich, sampling
from sevlens.plans import incidents as inc


def _hot_events(spark, base):
    ev = inc.table(spark, base, "events")
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))


def test_hot_customer_join_shuffle_equals_broadcast(spark, sf_small):
    events = _hot_events(spark, sf_small)
    customer = inc.table(spark, sf_small, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = enrich.enrich(events, customer, "user_id", max_broadcast_rows=0)
        plan = shuffled._jdf.queryExecution().executedPlan().toString()
        rows_shuffled = sorted(tuple(r) for r in shuffled.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert "BroadcastHashJoin" not in plan
    broadcast = enrich.enrich(events, customer, "user_id")
    assert rows_shuffled == sorted(tuple(r) for r in broadcast.collect())
    hot = sum(1 for r in rows_shuffled if r[0] == 0)
    assert hot * 3 >= len(rows_shuffled) - 3


def test_hot_state_aggregate_and_salted_spread(spark, sf_small):
    raw = inc.raw_incidents(spark, sf_small, events=_hot_events(spark, sf_small))
    preds = inc.rule_predictions(raw)
    out = aggregate.prediction_insights(preds, "label", "pred_a")
    total = out.agg(F.sum("Accident_Count")).first()[0]
    assert total == raw.where(F.col("State").isNotNull()).count()
    plain = sampling.partition_stats(sampling.repartition_by(raw, 8, "State")).first()
    salted = sampling.partition_stats(sampling.repartition_by(raw, 8, "State", spread=8)).first()
    assert salted.max_rows < plain.max_rows and salted.rows == plain.rows
