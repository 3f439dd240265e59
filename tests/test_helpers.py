"""Small helpers: vector cleaning, parallelism, sizing, broadcast guard."""

from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sevlens.operators import enrich, sampling
from sevlens.plans.pipeline import clean_vector
from sevlens.session import cluster_settings


def test_clean_vector_keeps_null_vectors(spark):
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", VectorUDT())])
    df = spark.createDataFrame([(1, Vectors.dense([1.0, float("nan"), float("inf")])), (2, None)], schema)
    got = {r.id: r.v for r in clean_vector(df, "v").collect()}
    assert list(got[1]) == [1.0, 0.0, 0.0] and got[2] is None


def test_ensure_parallelism(spark):
    narrow = spark.range(1000).withColumnRenamed("id", "ID").coalesce(1)
    wide = sampling.ensure_parallelism(narrow, "ID", 8)
    assert wide.rdd.getNumPartitions() == 8 and wide.count() == 1000
    already = spark.range(1000).withColumnRenamed("id", "ID").repartition(16)
    assert sampling.ensure_parallelism(already, "ID", 8) is already


def test_cluster_settings_scale_with_input():
    small = cluster_settings(10 * 2**30, 64)
    big = cluster_settings(100 * 2**40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 192          # cores dominate
    assert int(big["spark.sql.shuffle.partitions"]) == 819200         # bytes dominate
    assert big["spark.sql.adaptive.enabled"] == "true"


def test_broadcast_guard_uses_row_width(spark):
    df = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("s"))
    assert enrich.row_width(df) == 8 + 20
    plan_small = spark.range(10).withColumnRenamed("id", "k").join(
        enrich.broadcast_if_bounded(df), "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan_small.lower()
    guarded = enrich.broadcast_if_bounded(df, max_rows=50)
    plan = spark.range(10).withColumnRenamed("id", "k").join(guarded, "k") \
        ._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan
