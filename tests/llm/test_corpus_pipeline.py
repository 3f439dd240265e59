"""The corpus pipeline, stage by stage, against plain versions."""

import os
import sys

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

import corpus_pipeline as P  # noqa: E402
from sevlens.llm import mixing  # noqa: E402

SF = "/root/testdata/sf0.001"


def plain(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, labels = docs.columns, {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    one = P.STAGES[0][1](spark, docs, SF)
    left = plain(one)
    gone = {r.doc_id for r in docs.collect()} - {i for i, _ in left}
    assert one.columns == columns and not any(labels.get(i) == 0 for i in gone)
    two = P.STAGES[1][1](spark, one, SF)
    _, component = brute.jaccard(left)
    assert two.columns == columns and plain(two) == [(i, t) for i, t in left if component[i] == i]
    three = P.STAGES[2][1](spark, two, SF)
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = brute.contaminated(plain(two), items)
    assert three.columns == columns and plain(three) == [(i, t) for i, t in plain(two) if not bad[i]]
    four = P.STAGES[3][1](spark, three, SF)
    groups, _ = mixing.mix(three)
    want = sum(r["__mix_copies"] for r in mixing.with_copies(three, groups).collect())
    assert four.columns == columns and four.count() == want
    five = P.STAGES[4][1](spark, four, SF)
    assert sorted(map(tuple, five.collect())) == brute.tokens(plain(four))


def test_odd_rows_pass(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    odd = docs.selectExpr("CAST(NULL AS LONG) AS doc_id", "text", "lang", "CAST(NULL AS STRING) AS source", "n_chars").limit(2)
    odd = docs.unionByName(odd).unionByName(docs.selectExpr("doc_id + 1000 AS doc_id", "CAST(NULL AS STRING) AS text", "lang", "source", "n_chars").limit(3))
    odd = odd.unionByName(docs.limit(4)).selectExpr("*", "1 AS size", "'x' AS score", "2 AS base")
    for _, stage in P.STAGES[:4]:
        odd = stage(spark, odd, SF)
        assert odd.columns == [*docs.columns, "size", "score", "base"]
    n = odd.count()
    assert n and P.STAGES[4][1](spark, odd, SF).count() == n


def test_no_text_is_lost_under_a_shared_id(spark):
    a, b, c = ("alpha " * 12 + "one two three", " ".join(f"b{i}" for i in range(20)), " ".join(f"c{i}" for i in range(20)))
    rows = [(1, a), (1, b), (2, c), (3, b), (2, c), (None, a), (4, None), (4, None), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "x", 2) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, __id string, __hash int")
    got = P.distinct(spark, docs, SF)
    assert got.columns == docs.columns
    # the copy of a under a null id stands under a negative number and comes first
    assert sorted(plain_rows(got), key=str) == sorted([(None, a), (1, b), (2, c), (4, None), (5, "")], key=str)
    got = P.distinct(spark, docs.where("doc_id IS NOT NULL"), SF)
    assert sorted(plain_rows(got), key=str) == sorted([(1, a), (1, b), (2, c), (4, None), (5, "")], key=str)


def plain_rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in P.STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == 0
    assert P.STAGES[4][1](spark, docs, SF).count() == 0
