"""Corpus pipeline: toxicity, near duplicates, decontamination, mixing, token files.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the
last return the columns of ``docs``.  ``run`` writes each result as Parquet in the shared checkpoint
folder and reads it for the next stage.

Defined results: extra columns pass through; null and empty texts are kept by the first three
stages and encoded as their end id alone; rows that repeat both id and text are one document for the near
duplicates, rows of one id with other texts are documents of their own; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sevlens.llm import decontaminate, jaccard_join, mixing, token_output, toxicity
from sevlens.llm.common import fresh, read, stored, those_held
from sevlens.session import scratch_path

REJECT = 0.7


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.7."""
    model = toxicity.fit(toxicity.labelled(docs, read(spark, sf_dir, "labels")))
    score = fresh(docs, "__score")
    return toxicity.score(docs, model, score, fresh(docs, "__evidence")).where(F.col(score) < REJECT).select(*docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by a Jaccard similarity of 0.8 or more.

    Rows are known by id and text.  Only those to be dropped, or repeated as they are, meet in a join.
    """
    found = stored(jaccard_join.join(docs).select("id", "text_hash", "kept"), "near-duplicates")
    key, gone = [fresh(docs, "__id"), fresh(docs, "__hash")], fresh(docs, "__gone")
    some = found.groupBy("id", "text_hash").agg(F.max("kept").alias("kept"), F.count("*").alias("n")).where("NOT kept OR n > 1")
    some = stored(some.select(F.col("id").alias(key[0]), F.col("text_hash").alias(key[1]), (~F.col("kept")).alias(gone)), "dropped")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.withColumns({key[0]: F.coalesce(F.col("doc_id").cast("long"), -1 - F.shiftrightunsigned(F.xxhash64(text), 1)), key[1]: F.xxhash64(text)})
    once = those_held(rows, some, *key).join(some, key, "left").where(F.col(gone).isNull() | ~F.col(gone)).dropDuplicates(key)
    return those_held(rows, some, *key, how="left_anti").select(*docs.columns).unionByName(once.select(*docs.columns))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark's windows do not contaminate."""
    key = [fresh(docs, "__id"), fresh(docs, "__hash")]
    found = decontaminate.contamination(docs, read(spark, sf_dir, "benchmark")).where("contaminated")
    bad = stored(found.select(F.col("doc_id").alias(key[0]), F.col("text_hash").alias(key[1])).distinct(), "contaminated")
    same = F.col("doc_id").eqNullSafe(F.col(key[0])) & (F.xxhash64("text") == F.col(key[1]))
    return docs.join(bad, same, "left_anti")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    groups, _ = mixing.mix(docs, (3, 1, 2), 1.5, 2)
    taken = mixing.with_copies(docs, groups).where("__mix_copies > 0")
    return taken.withColumn(fresh(taken, "__copy"), F.explode(F.sequence(F.lit(1), F.col("__mix_copies")))).select(*docs.columns)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents; per document its place in them."""
    import public_tokenizers

    folder = scratch_path(spark, "tokens")
    shards = token_output.write_tokens(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), 50257)
    return token_output.read_tokens(stored(token_output.with_bases(stored(shards, "shards")), "bases"), folder, 50257)


STAGES = [("toxicity", clean), ("near_duplicates", distinct), ("decontamination", uncontaminated), ("mixing", mixed), ("token_output", token_files)]

#: Classifier, forest and tokenizer are beyond SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
