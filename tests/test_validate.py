"""Ingestion checks on a reference-style synthetic incident table (100 rows)."""

import datetime as dt

import numpy as np
import pytest

from sevlens.operators import profile, validate


@pytest.fixture(scope="module")
def incidents(spark):
    rng = np.random.default_rng(42)
    n = 100
    rows = []
    for i in range(n):
        temp = None if rng.random() < 0.1 else float(rng.uniform(20, 100))
        rows.append((f"A-{i}", "Source1", int(rng.integers(1, 5)), dt.datetime(2021, 6, 1, 8, 30),
                     dt.datetime(2021, 6, 1, 9, 0), float(rng.uniform(25, 48)), float(rng.uniform(-122, -70)),
                     temp, [None, "Clear", "Rain"][i % 3], ["CA", "TX", "FL", "NY", "OH"][i % 5]))
    schema = ("ID string, Source string, Severity int, Start_Time timestamp_ntz, End_Time timestamp_ntz, "
              "Start_Lat double, Start_Lng double, Temperature_F double, Weather_Condition string, State string")
    return spark.createDataFrame(rows, schema)


def test_shape(incidents):
    r = validate.shape(incidents).first()
    assert (r.rows, r.columns) == (100, 10)


def test_severity_domain(incidents):
    assert validate.domain_violations(incidents, "Severity").first().status == "PASS"
    bad = incidents.limit(3).selectExpr("5 AS Severity").unionByName(incidents.select("Severity"))
    r = validate.domain_violations(bad, "Severity").first()
    assert (r.violations, r.status) == (3, "FAIL")


def test_null_rows_are_not_domain_violations(spark):
    df = spark.createDataFrame([(None,), (2,)], "Severity int")
    assert validate.domain_violations(df).first().violations == 0


def test_coordinate_box(incidents):
    r = validate.range_violations(incidents).first()
    assert (r.violations, r.status) == (0, "PASS")


def test_null_report_status(incidents):
    rep = {r.column: r for r in validate.null_report(incidents, ["Temperature_F", "Weather_Condition",
                                                                  "State"]).collect()}
    assert rep["State"].null_count == 0 and rep["State"].status == "PASS"
    assert rep["Weather_Condition"].null_count == 34 and rep["Weather_Condition"].status == "WARN"


def test_not_all_null(incidents):
    rep = {r.column: r.all_null for r in validate.all_null_columns(incidents).collect()}
    assert not any(rep.values())


def test_missing_report_sorted(incidents):
    rows = profile.missing_report(incidents).collect()
    assert [r.column for r in rows][0] == "Weather_Condition"
    assert all(r.missing_pct > 0 for r in rows)


def test_top_k_ties_and_null_label(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), (None,), ("c",)], "w string")
    got = [(r.w, r["count"]) for r in profile.top_k(df, "w", 3).collect()]
    assert got == [("Unknown", 2), ("a", 1), ("b", 1)]


def test_quantiles_exact_on_small_input(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4]], "x double")
    got = {r.prob: r.value for r in profile.quantiles(df, ["x"], (0.25, 0.5, 0.75)).collect()}
    assert got == {0.25: 1.0, 0.5: 2.0, 0.75: 3.0}


def test_bounds_report(spark):
    df = spark.createDataFrame([(0,), (23,)], "Hour int")
    r = validate.bounds_report(df, {"Hour": (0, 23)}).first()
    assert r.within and (r.min, r.max) == (0.0, 23.0)


def test_invalid_rows_name_their_broken_rules(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (2, 9, 5.0), (3, None, 50.0), (4, 1, None), (5, 9, 11.0)], "id int, a int, x double")
    got = {r.id: r.reasons for r in validate.invalid_rows(df, {"a": (1, 2)}, {"x": (0.0, 10.0)}, ["x"]).collect()}
    assert got == {2: ["domain:a"], 3: ["range:x"], 4: ["null:x"], 5: ["domain:a", "range:x"]}
    assert validate.invalid_rows(df).count() == 0


def test_column_presence_counts_and_misses(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, s string")
    got = [tuple(r) for r in validate.column_presence(df, ["s", "id", "gone"]).collect()]
    assert sorted(got) == [("gone", False, None), ("id", True, 2), ("s", True, 1)]
