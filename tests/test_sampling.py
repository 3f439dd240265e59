"""Splits and samples are stable under repartitioning and cover every row once."""

from pyspark.sql import functions as F

from sevlens.operators import enrich, sampling
from sevlens.plans import incidents as inc


def _ids(spark, n=10_000):
    return spark.range(n).withColumnRenamed("id", "ID")


def test_split_covers_each_row_once(spark):
    df = _ids(spark)
    parts = sampling.split(df)
    total = sum(p.count() for p in parts.values())
    assert total == 10_000
    assert enrich.split_overlap(parts["train"], parts["test"]).count() == 0
    assert abs(parts["train"].count() / 10_000 - 0.70) < 0.02


def test_split_independent_of_partitioning(spark):
    a = sampling.assign_split(_ids(spark).repartition(2)).where(F.col("split") == "test")
    b = sampling.assign_split(_ids(spark).repartition(7)).where(F.col("split") == "test")
    assert sorted(r.ID for r in a.collect()) == sorted(r.ID for r in b.collect())


def test_sample_fraction_and_cap(spark):
    df = _ids(spark)
    s = sampling.sample_fraction(df, 0.1).count()
    assert 850 < s < 1150
    assert sampling.sample_cap(df, 250).count() == 250
    assert sampling.sample_cap(df.limit(10), 250).count() == 10


def test_temporal_split(spark):
    import datetime as dt
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 23)),
                                (3, dt.datetime(2024, 1, 29))], "ID long, ts timestamp_ntz")
    out = sampling.temporal_split(df, "ts", [dt.datetime(2024, 1, 22), dt.datetime(2024, 1, 26)])
    assert [r.split for r in out.orderBy("ID").collect()] == ["train", "valid", "test"]


def test_split_summary_shares(spark):
    rows = sampling.split_summary(sampling.assign_split(_ids(spark))).collect()
    assert abs(sum(r.share for r in rows) - 1.0) < 1e-6


def test_partition_stats_counts_empty_partitions(spark):
    df = spark.range(10).repartition(4, "id").coalesce(4)
    r = sampling.partition_stats(spark.range(3).repartition(8)).first()
    assert r.partitions == 8 and r.rows == 3 and r.min_rows == 0
    r2 = sampling.partition_stats(df).first()
    assert r2.rows == 10


def test_cached_unpersists(spark):
    df = _ids(spark, 100)
    with sampling.cached(df) as c:
        assert c.count() == 100 and c.is_cached
    assert not df.is_cached


def test_salted_repartition_spreads_a_hot_key(spark):
    hot = spark.range(30_000).select(F.col("id").alias("ID"), F.lit("HOT").alias("State"))
    plain = sampling.partition_stats(sampling.repartition_by(hot, 8, "State")).first()
    salted = sampling.partition_stats(sampling.repartition_by(hot, 8, "State", spread=8)).first()
    assert plain.max_rows == 30_000
    assert salted.max_rows < 30_000 and salted.rows == 30_000


def test_sample_of_each_split_has_its_share(spark):
    for name, part in sampling.split(spark.range(20_000).withColumnRenamed("id", "ID")).items():
        n = part.count()
        for share in (0.1, 0.2, 0.5):
            kept = sampling.sample_fraction(part, share).count()
            assert abs(kept - share * n) < 3 * (n * share * (1 - share)) ** 0.5 + 1, (name, share)
        assert sampling.sample_cap(part, 500).count() == 500


def test_fixed_partitions_follow_from_the_data(spark, sf_small):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = inc.raw_incidents(spark, sf_small, state=False).select("ID", (F.col("Severity") - 1).cast("double").alias("label"), "Start_Lat", "Distance_mi")
    rows = VectorAssembler(inputCols=["Start_Lat", "Distance_mi"], outputCol="features").transform(rows)
    trees = set()
    for given in (rows.repartition(3), rows.repartition(11).orderBy(F.desc("ID"))):
        fixed = sampling.fixed_partitions(given, 1000)
        assert fixed.rdd.getNumPartitions() == sampling.MIN_TRAIN_PARTITIONS
        trees.add(RandomForestClassifier(numTrees=3, maxDepth=4, seed=1).fit(fixed).toDebugString.split("\n", 1)[1])
    assert len(trees) == 1
    assert sampling.fixed_partitions(rows, 1_000_001).rdd.getNumPartitions() == 11


def test_training_partitions_grow_slower_than_the_rows(spark):
    """A level's statistics go once through every partition, so their number must not follow the rows."""
    assert [sampling.training_partitions(n) for n in (0, 70_000, 800_000, 1_000_001)] == [8, 8, 8, 11]
    for rows in (1_250_000, 6_000_000, 36_000_000, 10 ** 9):
        assert sampling.training_partitions(4 * rows) <= 2 * sampling.training_partitions(rows)
    rows = _ids(spark, 100)
    assert sampling.fixed_partitions(rows, 36_000_000).rdd.getNumPartitions() == 68
