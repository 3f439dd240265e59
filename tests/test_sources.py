"""File sources and sinks: CSV with schema and corrupt rows, partitioned Parquet, JSON metrics."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sevlens.plans import incidents as inc
from sevlens.sources import files
from sevlens.session import scratch_path


def test_csv_roundtrip_keeps_values(spark, sf_small):
    raw = inc.raw_incidents(spark, sf_small)
    path = files.write_csv(raw, scratch_path(spark, "t-csv"))
    back = files.read_csv(spark, path, raw.schema)
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0


def test_reference_timestamp_format_reads_whole_and_fractional(spark):
    path = scratch_path(spark, "t-ts")
    spark.createDataFrame([("1", "2021-06-01 08:30:00"), ("2", "2021-06-01 08:30:00.25"), ("3", "garbage")],
                          "id string, ts string").write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("ts", T.TimestampNTZType())])
    got = {r.id: r.ts for r in files.read_csv(spark, path, schema).collect()}
    assert got[1].second == 0 and got[2].microsecond == 250000 and got[3] is None


def test_corrupt_rows_are_captured(spark):
    path = scratch_path(spark, "t-corrupt")
    spark.createDataFrame([("1", "2"), ("2", "x"), ("3", "4")], "a string, b string") \
        .write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    good, bad = files.split_corrupt(files.read_csv_with_corrupt(spark, path, schema))
    assert sorted(r.a for r in good.collect()) == [1, 3]
    assert [r[files.CORRUPT_COLUMN] for r in bad.collect()] == ["2,x"]
    plan = bad._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_is_corrupt" in plan and "csv" not in plan.lower().replace("csv_", "")
    clean = files.read_csv_with_corrupt(spark, path, schema).where("_corrupt_record IS NULL")
    good, bad = files.split_corrupt(clean)
    assert good.count() == 2 and bad.count() == 0


def test_partitioned_write_and_verify(spark, sf_small):
    df = inc.enriched_incidents(spark, sf_small)
    path = files.write_partitioned(df, scratch_path(spark, "t-part"), "State")
    rows = df.count()
    r = files.verify_write(spark, path, df.schema, rows, "State").first()
    assert r.rows_match and r.schema_match
    assert r.partition_values == df.select("State").distinct().count()
    states = df.select("State").distinct().count()
    parts = files.write_partitioned(df.repartition(40), scratch_path(spark, "t-clustered"), "State", max_records_per_file=100)
    written = spark.read.parquet(parts).select(F.input_file_name()).distinct().count()
    assert written <= states + rows // 100      # whatever the number of scan tasks
    seen_df, seen = files.observed(df)
    files.write_parquet(seen_df, scratch_path(spark, "t-observed"))
    nulls = df.select(sum(F.count_if(F.col(c).isNull()) for c in df.columns).alias("n")).first().n
    assert seen.get == {"rows": rows, "null_cells": nulls}
    back = spark.read.parquet(path).where(F.col("State") == "NATION_3")
    assert "PartitionFilters: [isnotnull(State" in back._jdf.queryExecution().executedPlan().toString()


def test_schema_json_roundtrip(spark, sf_small):
    df = inc.raw_incidents(spark, sf_small)
    assert files.schema_from_json(files.schema_to_json(df)) == df.schema


def test_metrics_json_roundtrip(spark):
    df = spark.createDataFrame([("rf", 0.61, None)], "model string, acc double, auc double")
    path = files.write_metrics(df, scratch_path(spark, "t-json"))
    assert files.read_metrics(spark, path, df.schema).collect() == df.collect()


def test_export_csv_single_file(spark):
    import os
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    path = files.export_csv(df, scratch_path(spark, "t-export"))
    local = path.replace("file:", "")
    parts = [p for p in os.listdir(local) if p.startswith("part-")]
    assert len(parts) == 1


def test_enrich_left_join_keeps_unknown_and_null_keys(spark):
    from sevlens.operators.enrich import enrich
    facts = spark.createDataFrame([(1, "CA"), (2, "ZZ"), (3, None)], "ID int, State string")
    lookup = spark.createDataFrame([("CA", "West")], "State string, Region string")
    out = enrich(facts, lookup, "State")
    assert out.columns == ["State", "ID", "Region"]          # key once and first
    got = {r.ID: r.Region for r in out.collect()}
    assert got == {1: "West", 2: None, 3: None}
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_inline_lookup_enrichment(spark):
    from sevlens.operators.enrich import enrich
    from sevlens.sources.tables import inline_table
    lookup = inline_table(spark, [("CA", "West"), ("TX", "South"), ("FL", "South"), ("NY", "Northeast"),
                                  ("OH", "Midwest")], "State string, Region string")
    facts = spark.createDataFrame([(i, s) for i, s in enumerate(["CA", "TX", "OH", "WA"])],
                                  "ID int, State string")
    out = {r.ID: r.Region for r in enrich(facts, lookup, "State").collect()}
    assert out == {0: "West", 1: "South", 2: "Midwest", 3: None}
