"""Driver contract: entry runs, every oracle has a query, and queries run on the smallest tables."""

import pytest

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["Region", "Hour", "incidents", "peak_incidents", "weekend_incidents", "avg_severity"]


def test_oracles_have_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.oracle_sql()) >= 60


FAST = ["v02_null_report", "m08_roc_curve", "m12_bootstrap_ci", "g08_partition_stats",
        "a04_prediction_insights", "s02_corrupt_records", "w05_union_reports"]


@pytest.mark.parametrize("key", FAST)
def test_query_runs(spark, sf_small, key):
    df = E.queries()[key](spark, sf_small)
    assert df.count() >= 0 and len(df.columns) > 0
