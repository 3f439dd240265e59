"""Physical-plan properties the operators rely on at scale."""

from pyspark.sql import functions as F

from sevlens.operators import profile
from sevlens.plans import incidents as inc
from sevlens.plans import queries as Q


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns_and_pushes_filters(spark, sf_small):
    df = inc.raw_incidents(spark, sf_small, state=False).where(F.col("ID") < 100).select("ID", "Severity")
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "PushedFilters: [IsNotNull(event_id), LessThan(event_id,100)]" in plan
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan


def test_dimension_joins_are_broadcast(spark, sf_small):
    plan = _plan(inc.enriched_incidents(spark, sf_small))
    assert plan.count("BroadcastHashJoin") >= 3
    assert "SortMergeJoin" not in plan


def test_feature_projection_stays_in_the_jvm(spark, sf_small):
    plan = _plan(Q.featured(spark, sf_small))
    for python_node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert python_node not in plan


def test_top_k_uses_take_ordered(spark, sf_small):
    plan = _plan(profile.top_k(inc.raw_incidents(spark, sf_small), "State", 10))
    assert "TakeOrderedAndProject" in plan


def test_aggregates_combine_map_side(spark, sf_small):
    plan = _plan(Q.flagship(spark, sf_small))
    assert plan.count("HashAggregate") >= 2 or "partial_" in plan


def test_state_is_joined_only_where_it_is_used(spark, sf_small):
    from sevlens.plans import queries as Q
    for key in ("v01_shape", "v05_class_distribution", "m01_accuracy"):
        name = next(k for k in Q.REGISTRY if k.startswith(key.split("_")[0] + "_"))
        plan = Q.REGISTRY[name](spark, sf_small)._jdf.queryExecution().optimizedPlan().toString()
        assert "customer" not in plan and "LeftOuter" not in plan, name


def test_state_join_needs_no_aggregate_of_the_dimension(spark, sf_small):
    plan = inc.raw_incidents(spark, sf_small)._jdf.queryExecution().sparkPlan().toString()
    assert "Aggregate" not in plan and plan.count("BroadcastHashJoin") == 2
    assert inc.raw_incidents(spark, sf_small).count() == inc.table(spark, sf_small, "events").count()
