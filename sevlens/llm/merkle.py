"""Merkle manifest of a dataset in van Emde Boas blocks.

Every row is a leaf; per source the leaves ascend by id, and every three consecutive nodes become
their parent until one remains.  A tree is cut into aligned subtrees of ``height`` levels of
parents (at most 3 ** height leaves), each built in one task and stored as one row; their roots are the
leaves of the next round, and the roots of the sources, in order of source, are the leaves of a
last tree.  In a block the digests lie in van Emde Boas order: the upper half of the levels
first, then each lower subtree, both laid out alike; :func:`address` gives a node's place, for
building and for fetching siblings.  Siblings above a block travel down with its row, so a task sees one
block at a time however large a source is.  Positions come from a range sort and
prefix sums of its partitions' counts.

Defined results: a null field counts as ``-``; a null id comes first in its source, a null source
before all others; equal ids follow the order of their leaves; repeated rows are leaves of their own;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sevlens.llm.common import placed, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RUN = 3
HEIGHT = 6


def field(c: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(text: Column) -> Column:
    return F.sha2(F.concat(*[field(text if x == "text" else F.col(x)) for x in FIELDS]), 256)


def subtree(levels: int) -> int:
    """Nodes of a whole tree of so many levels."""
    return (RUN ** levels - 1) // (RUN - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of the nodes ``index`` at ``depth`` (the root's is 0) of a tree of ``levels`` levels."""
    at = np.zeros(len(index), np.int64)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        below = RUN ** (depth - top)
        at += subtree(top) + index // below * subtree(levels - top)
        index, depth, levels = index % below, depth - top, levels - top
    return at


def digest(nodes: list[bytes]) -> bytes:
    """Digest of the nodes' digests, written as hexadecimal text."""
    return hashlib.sha256(b"".join(n.hex().encode() for n in nodes)).digest()


def levels_of(n: int, size: int, height: int) -> int:
    """Levels of a block of ``n`` nodes in a tree of ``size`` nodes; only a tree's last block may be lower than ``height``."""
    if size > RUN ** height:
        return height + 1
    levels = 1
    while n > 1:
        n, levels = -(-n // RUN), levels + 1
    return levels


class Block:
    """An aligned subtree; ``data`` holds its digests in van Emde Boas order, absent nodes as zeros."""

    def __init__(self, levels: int, n: int, data: bytes | None = None):
        self.levels, self.n = levels, n
        self.data = bytearray(data or 32 * subtree(levels))

    def count(self, up: int) -> int:
        """Nodes that are ``up`` levels above the lowest."""
        return -(-self.n // RUN ** up)

    def places(self, up: int) -> list[int]:
        return address(self.levels, self.levels - 1 - up, np.arange(self.count(up))).tolist()

    def level(self, up: int) -> list[bytes]:
        return [bytes(self.data[32 * p:32 * p + 32]) for p in self.places(up)]

    def put(self, up: int, nodes: list[bytes]) -> None:
        for p, node in zip(self.places(up), nodes):
            self.data[32 * p:32 * p + 32] = node

    @classmethod
    def built(cls, nodes: list[bytes], size: int, height: int) -> Block:
        block = cls(levels_of(len(nodes), size, height), len(nodes))
        block.put(0, nodes)
        for up in range(1, block.levels):
            nodes = [digest(nodes[i:i + RUN]) for i in range(0, len(nodes), RUN)]
            block.put(up, nodes)
        return block

    def root(self) -> bytes:
        return bytes(self.data[:32])

    def paths(self) -> list[list[tuple[list[bytes], list[bytes]]]]:
        """For each of the lowest nodes its siblings to the left and right, level by level up to the block's root."""
        known: list[list] = [[]]
        for up in range(self.levels - 2, -1, -1):
            nodes, out = self.level(up), []
            for i in range(len(nodes)):
                s = i - i % RUN
                out.append([(nodes[s:i], nodes[i + 1:s + RUN]), *known[i // RUN]])
            known = out
        return known


def packed(path: list) -> bytes:
    return b"".join(bytes((len(a), len(b))) + b"".join(a + b) for a, b in path)


def unpacked(data: bytes) -> list[tuple[list[bytes], list[bytes]]]:
    out, at = [], 0
    while at < len(data):
        a, b = data[at], data[at + 1]
        nodes = [data[at + 2 + 32 * i:at + 34 + 32 * i] for i in range(a + b)]
        out.append((nodes[:a], nodes[a:]))
        at += 2 + 32 * (a + b)
    return out


def proof(path: list) -> bytes:
    return digest([n for a, b in path for n in a + b])


def fold(node: bytes, path: list) -> bytes:
    """Root that the node and its siblings give."""
    for a, b in path:
        node = digest([*a, node, *b])
    return node


def rounds(nodes: DataFrame, name: str, height: int) -> tuple[list[DataFrame], DataFrame]:
    """(block tables from the leaves up, (tree, root)) of the trees of ``nodes`` (tree, pos, size, digest)."""
    width = RUN ** height

    def build(key: tuple, t: pa.Table) -> pa.Table:
        order = np.argsort(t["pos"].to_numpy())
        leaves = t["digest"].to_pylist()
        block = Block.built([leaves[i] for i in order], t["size"][0].as_py(), height)
        return pa.table({"tree": [key[0].as_py()], "block": [key[1].as_py()], "size": [t["size"][0].as_py()], "levels": pa.array([block.levels], pa.int32()),
                         "n": pa.array([block.n], pa.int32()), "data": pa.array([bytes(block.data)], pa.binary()), "root": pa.array([block.root()], pa.binary())})

    tables = []
    while True:
        cut = nodes.withColumn("block", F.expr(f"pos div {width}"))
        blocks = stored(cut.groupBy("tree", "block").applyInArrow(
            build, "tree string, block long, size long, levels int, n int, data binary, root binary"), f"{name}-{len(tables)}")
        tables.append(blocks)
        most = blocks.agg(F.max("size")).first()[0] or 0
        if most <= width:
            return tables, blocks.select("tree", "root")
        nodes = blocks.select("tree", F.col("block").alias("pos"), F.expr(f"(size + {width - 1}) div {width}").alias("size"), F.col("root").alias("digest"))


def descend(blocks: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """(tree, block, path, subroot, origin) of the blocks below, from those of these (``above``)."""
    width = RUN ** height

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                paths = [packed(p) + r["path"] for p in Block(r["levels"], r["n"], r["data"]).paths()]
                n = len(paths)
                yield pa.RecordBatch.from_pydict({"tree": [r["tree"]] * n, "block": pa.array(r["block"] * width + np.arange(n)), "path": pa.array(paths, pa.binary()),
                                                  "subroot": pa.array([r["subroot"]] * n, pa.binary()), "origin": pa.array([r["origin"]] * n, pa.binary())})

    return blocks.drop("root").join(above, ["tree", "block"]).mapInArrow(run, "tree string, block long, path binary, subroot binary, origin binary")


def manifest(docs: DataFrame, height: int = HEIGHT) -> tuple[DataFrame, list[DataFrame], list[DataFrame], DataFrame]:
    """(leaves with places, block tables of the sources, block tables of the last tree, subroots with places).

    Leaves: (tree, doc_id, digest, claimed, pos, size); ``claimed`` is the leaf of the tampered row.
    """
    text = F.col("text").cast("string")
    even = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0
    rows = docs.select(F.coalesce(F.concat(F.lit("1"), F.col("source").cast("string")), F.lit("0")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.unhex(leaf(text)).alias("digest"), F.when(even & text.contains("\n"), F.unhex(leaf(F.replace(text, F.lit("\n"), F.lit(""))))).alias("claimed"))
    leaves = stored(placed(rows, ["doc_id", "digest"], "merkle"), "merkle-places")
    lower, roots = rounds(leaves.select("tree", "pos", "size", "digest"), "merkle-blocks", height)
    sources = stored(placed(roots.select(F.lit("").alias("tree"), F.col("tree").alias("own"), F.col("root").alias("digest")), ["own"], "merkle-roots"), "merkle-sources")
    upper, _ = rounds(sources.select("tree", "pos", "size", "digest"), "merkle-top", height)
    return leaves, lower, upper, sources


def proofs(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of ``docs``."""
    leaves, lower, upper, sources = manifest(docs, height)
    none = F.lit(b"").cast("binary")
    above = upper[-1].select("tree", "block", none.alias("path"), none.alias("subroot"), F.col("root").alias("origin"))
    for blocks in reversed(upper):
        above = descend(blocks, above, height)
    above = (above.select(F.col("block").alias("pos"), "path", "origin").join(sources.select("pos", "own", "digest"), "pos")
             .select(F.col("own").alias("tree"), F.lit(0).cast("long").alias("block"), "path", F.col("digest").alias("subroot"), "origin"))
    for blocks in reversed(lower[1:]):
        above = descend(blocks, above, height)
    tops = lower[0].drop("root", "size").join(above, ["tree", "block"])
    width = RUN ** height

    def check(rows: pa.Table, block: pa.Table) -> pa.Table:
        top = block.to_pylist()[0]
        rest, inner = unpacked(top["path"]), Block(top["levels"], top["n"], top["data"]).paths()
        out = []
        for i, pos, own, claimed in zip(*(rows[c].to_pylist() for c in ("doc_id", "pos", "digest", "claimed"))):
            path = inner[pos % width] + rest
            root = fold(claimed or own, path)
            out.append((i, own.hex(), top["subroot"].hex(), top["origin"].hex(), proof(path).hex(), root.hex(), root == top["origin"]))
        return pa.table([pa.array(x) for x in zip(*out)], schema=pa.schema(
            [("doc_id", pa.int64()), *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], ("verified", pa.bool_())]))

    mine = leaves.withColumn("block", F.expr(f"pos div {width}")).groupBy("tree", "block")
    return mine.cogroup(tops.groupBy("tree", "block")).applyInArrow(
        check, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
