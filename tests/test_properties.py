"""Property checks against brute force on small random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sevlens.operators import evaluate, sampling, windows

rows_strategy = st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=2, max_size=40)


def _pairwise_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    if not pos or not neg:
        return 0.0
    wins = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    return wins / (len(pos) * len(neg))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy)
def test_auc_equals_pairwise_count(spark, rows):
    df = spark.createDataFrame([(float(y), float(s) / 3.0) for y, s in rows], "label double, score double")
    g = evaluate.score_groups(df, {"c": "score"}, "label", positive={"c": F.col("label") == 1})
    got = evaluate.roc_auc(g).first().auc
    assert abs(got - round(_pairwise_auc(rows), 6)) < 1e-9


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=st.lists(st.integers(0, 1000), min_size=1, max_size=60, unique=True),
       ranges=st.sampled_from([None, 1, 2, 9, 40]))
def test_running_sums_equal_prefix_sums(spark, vals, ranges):
    df = spark.createDataFrame([(0, float(v), v % 7) for v in vals], "k int, s double, m int")
    got = {r.s: r.cum_m for r in windows.running_sums(df, ["k"], "s", ["m"], ranges=ranges).collect()}
    acc, want = 0, {}
    for v in sorted(vals, reverse=True):
        acc += v % 7
        want[float(v)] = acc
    assert got == want


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(1, 300), total=st.integers(1, 600))
def test_sample_cap_is_the_n_smallest_hashes(spark, n, total):
    from sevlens.functions.hashing import unit_hash
    df = spark.range(total).withColumnRenamed("id", "ID")
    got = sorted(r.ID for r in sampling.sample_cap(df, n).collect())
    ranked = df.withColumn("h", unit_hash("ID", f"sample:{sampling.SEED}")).orderBy("h", "ID").limit(n)
    assert got == sorted(r.ID for r in ranked.collect())
