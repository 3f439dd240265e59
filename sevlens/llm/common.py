"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from sevlens.session import scratch_path

#: Words of the n-gram operators: runs of digits, ASCII letters and any non-ASCII character.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table.  Python workers find this package where the driver does (on a cluster, as installed)."""
    home, env = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), spark.sparkContext.environment
    if home not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), home) if x)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Cuts lineage: a lost executor costs a re-read of those files, and every
    later step sees the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_and_seen(df: DataFrame, name: str, **seen: Column) -> tuple[DataFrame, dict]:
    """``stored``, and aggregates of the rows that the same write gathers.

    A loop that asks after each round whether to go on would else run a second query a round, and what the
    driver holds follows the queries of the last minute: plans, and a thread for each exchange.
    """
    found = Observation()
    kept = stored(df.observe(found, *[c.alias(k) for k, c in seen.items()]), name)
    return kept, found.get


#: Bits of the map of a key set that is broadcast, whatever the set's size: 8 MB.
MAP_BITS = 1 << 26


def may_hold(keys: DataFrame, *columns: str) -> Column:
    """Condition on rows with ``columns`` (of the same types): false only where no row of ``keys`` has their values.

    A bit map of the keys' hashes, of fixed size, is broadcast; only the hash goes to Python.  Rows
    it lets through need an exact join, the others none, so a join with a few
    keys moves few texts.  A fuller map lets more rows through.
    """
    cell = F.pmod(F.xxhash64(*columns), F.lit(MAP_BITS)) + 1
    found = keys.select(cell.alias("c")).groupBy(F.bitmap_bucket_number("c").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("c")).alias("bits")).collect()
    bits = np.zeros(MAP_BITS // 8, np.uint8)
    for r in found:
        bits[(r["b"] - 1) * 4096:r["b"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    shared = keys.sparkSession.sparkContext.broadcast(bits)

    def held(c: pd.Series) -> pd.Series:
        at = c.to_numpy() - 1
        return pd.Series((shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))

    return pandas_udf(held, "boolean")(cell)


def small_batches(spark: SparkSession, size: str = "4m") -> None:
    """From now on in this session, rows go to Python in Arrow batches of ``size`` at most, unless it has a limit of its own.

    Spark's limit of 10,000 rows lets a batch of texts take tens of MB, several times over in the executor and its workers.
    """
    if (limit := "spark.sql.execution.arrow.maxBytesPerBatch") not in spark.conf.getAll:
        spark.conf.set(limit, size)


def those_held(rows: DataFrame, keys: DataFrame, *columns: str, how: str = "left_semi") -> DataFrame:
    """The rows that ``may_hold`` lets through, by a broadcast join with the parts of the map; ``left_anti``: the others.

    No Python takes part: beside a step in Python, a function for the condition would keep a second
    worker with each core, and idle workers hold their memory.
    """
    cell = F.pmod(F.xxhash64(*columns), F.lit(MAP_BITS)) + 1
    part, bits, at = fresh(rows, "__map_part"), fresh(rows, "__map_bits"), F.bitmap_bit_position(cell)
    parts = keys.select(cell.alias("c")).groupBy(F.bitmap_bucket_number("c").alias(part)).agg(F.bitmap_construct_agg(F.bitmap_bit_position("c")).alias(bits))
    byte = F.conv(F.hex(F.substring(F.col(bits), F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.getbit(byte, at.bitwiseAND(F.lit(7)).cast("int")) == 1
    return rows.join(F.broadcast(parts), (F.bitmap_bucket_number(cell) == F.col(part)) & held, how)


def fresh(df: DataFrame, name: str) -> str:
    """A name that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def placed(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` (tree, ...) with ``pos``, the row's place in its tree by ``order``, and ``size``, the tree's rows."""
    fields = df.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, k = None, 0
        for batch in batches:
            tree = np.array(batch.column("tree").to_pylist(), object)
            first = np.nonzero(np.append(True, tree[1:] != tree[:-1]))[0] if len(tree) else []
            at = np.arange(len(tree))
            for s in first:
                at[s:] -= at[s]
            if len(tree) and tree[0] == last:
                at[:first[1] if len(first) > 1 else len(tree)] += k
            if len(tree):
                last, k = tree[-1], int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64())], names=[*batch.schema.names, "k"])

    df = stored(df.withColumn("tie", F.monotonically_increasing_id()), f"{name}-leaves")
    by = ["tree", *order, "tie"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != "tie")
    runs = df.repartitionByRange(*by).sortWithinPartitions(*by).drop("tie").withColumn("part", F.spark_partition_id())
    runs = stored(runs.mapInArrow(number, f"{schema}, part int, k long"), f"{name}-runs")
    counts = runs.groupBy("tree", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("tree").orderBy("part")
    counts = counts.select("tree", "part", F.sum("n").over(before).alias("upto"), "n", F.sum("n").over(Window.partitionBy("tree")).alias("size"))
    return runs.join(counts, ["tree", "part"]).select(*fields, (F.col("k") + F.col("upto") - F.col("n")).alias("pos"), "size")


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3, is 1 (a null id is never held out)."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def bounded_sample(df: DataFrame, label: str, n: int, key: str = "doc_id") -> DataFrame:
    """At most ``n`` rows for each value of ``label``, the smallest by a hash of ``key``.

    Counts per label give a hash threshold that keeps about 2 n rows of a label, so
    that the exact choice of n never sorts a large label in one task.
    """
    limits = {x: (2 * n + 50) / c for x, c in df.groupBy(label).count().collect() if x is not None}    # a model has a part for each label
    if not limits:
        return df.limit(0)
    share = F.pmod(F.xxhash64(F.lit("fit sample"), F.col(key)), F.lit(1_000_003)) / 1_000_003
    limit = F.element_at(F.create_map(*[F.lit(v) for kv in limits.items() for v in kv]), F.col(label))
    near = df.where(F.col(label).isNotNull()).withColumn("_h", F.xxhash64(F.lit("fit order"), F.col(key))).where(share <= limit)
    w = Window.partitionBy(label).orderBy("_h", key)
    return near.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_h", "_r")


def strings(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column, null as the empty string."""
    return [x or "" for x in column.to_pylist()]


def rebatched(batches: Iterator[pa.RecordBatch], size: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes (a single larger row stays whole)."""
    for batch in batches:
        parts = max(1, -(-batch.nbytes // size))
        step = max(1, -(-batch.num_rows // parts))
        for i in range(0, batch.num_rows, step):
            yield batch.slice(i, step)


def connected_components(edges: DataFrame, name: str = "cc", rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v long); component is its smallest node.

    Alternating large-star and small-star steps; every step links nodes to smaller
    ones, each round is written to shared storage, and the driver sees two numbers
    per round.  A hub's edges are never collected: its minimum is a partial
    aggregate and the join on the hub is one that adaptive execution can split.
    """
    e = (edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
         .distinct())
    e = stored(e, name)
    before = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e, now = stored_and_seen(small.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
                                 .unionByName(low.select("u", F.col("m").alias("v")))
                                 .where("u <> v").distinct(), name,
                                 n=F.count("*"), hashes=F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    star = e.groupBy("u").agg(F.min("v").alias("component"))
    roots = star.select(F.col("component").alias("node"), "component").distinct()
    return star.select(F.col("u").alias("node"), "component").unionByName(roots)


def min_roots(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Smallest reachable index of each of 0..n-1 over the undirected edges (u, v)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new
