"""Prefix trie of conversations by z-fast tries.

A conversation is the sequence of its turns (role, text); each prefix has a key chained from the turns'
digests.  Distinct sequences are sorted by their turns' digests into ranges, and every task
builds z-fast tries over runs of at most ``run`` sequences: compacted nodes hashed at the key of
their two-fattest depth, so that a fat binary search finds a sequence's exit node in a
logarithmic number of look-ups; sequences are inserted in batches, first located all against the trie
as it stands.  Edges are then expanded into one node for each depth.

A node that belongs to several tries lies on the path of a trie's first or last sequence.
Those open nodes alone are merged, tries by groups of neighbours, round after round, until
every node is closed; a node's counts are final when it closes, so no task ever holds more than a run of
sequences or the outer paths of a group of tries.  The members that end in a node are joined in pieces
by ranges of their ids; the pieces are fed in order to the node's digest, which is sequential by nature.

Defined results: null roles and texts are empty; turns of equal number follow the order of their
digests; rows of null conv_id belong to no conversation; repeated rows are turns of their own; an empty table
has no node; other columns are ignored.  A conversation's turns are one row, as a text is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sevlens.llm.common import stored

ROOT = b""
RUNS = 24       # bits for the number of a trie in its task
NODE = "trie long, key binary, parent binary, depth int, low long, n long, children long, leaves long, saved long, size long, ends string, first boolean, last boolean, open boolean, parent_low long"
NAMES = [c.split()[0] for c in NODE.split(", ")]
ARROW = pa.schema([(c.split()[0], {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}[c.split()[1]])
                   for c in NODE.split(", ")])


def chained(turns: list[str]) -> list[bytes]:
    """Keys of the prefixes of one turn or more."""
    out, key = [], ROOT
    for t in turns:
        key = hashlib.blake2b(key + t.encode(), digest_size=16).digest()
        out.append(key)
    return out


def two_fattest(a: int, b: int) -> int:
    """The number in (a, b] that the greatest power of two divides."""
    return b & (-1 << ((a ^ b).bit_length() - 1))


class Node:
    """A compacted node: ``depth`` and ``keys`` (of any sequence below it) of its longest prefix, the parent's depth above."""

    __slots__ = ("above", "children", "depth", "ends", "keys", "low", "n", "parent", "sizes")

    def __init__(self, parent: Node | None, above: int, depth: int, keys: list[bytes], sizes: list[int]):
        self.parent, self.above, self.depth, self.keys, self.sizes = parent, above, depth, keys, sizes
        self.children: list[Node] = []
        self.ends, self.low, self.n = None, None, 0

    def handle(self) -> bytes:
        return self.keys[two_fattest(self.above, self.depth) - 1]

    def extent(self) -> bytes:
        return self.keys[self.depth - 1] if self.depth else ROOT


class ZFastTrie:
    """Compacted nodes found by their handles, and below a node by the first key of the edge."""

    def __init__(self) -> None:
        self.root = Node(None, -1, 0, [], [])
        self.handles: dict[bytes, Node] = {}
        self.edges: dict[bytes, Node] = {}

    def exit(self, keys: list[bytes], start: Node) -> Node:
        """Node on whose edge, or in which, the sequence leaves the trie; ``start`` is a node whose prefix it has."""
        at, a, b = start, start.depth, len(keys)
        while a < b:
            f = two_fattest(a, b)
            node = self.handles.get(keys[f - 1])
            if node is None:
                b = f - 1
            elif node.depth <= len(keys) and keys[node.depth - 1] == node.extent():
                at, a = node, node.depth
                b = max(a, b)
            else:
                return node
        return self.edges.get(keys[at.depth], at) if at.depth < len(keys) else at

    def insert(self, keys: list[bytes], sizes: list[int], node: Node) -> Node:
        """The node of a sequence that leaves the trie at ``node``."""
        lo, hi = max(node.above, 0), min(node.depth, len(keys))
        while lo < hi:                              # turns in common, between the ends of the edge
            mid = (lo + hi + 1) // 2
            if keys[mid - 1] == node.keys[mid - 1]:
                lo = mid
            else:
                hi = mid - 1
        if lo < node.depth:                         # the edge is cut, its lower part gets another handle
            del self.handles[node.handle()]
            upper = Node(node.parent, node.above, lo, node.keys, node.sizes)
            siblings = node.parent.children
            siblings[siblings.index(node)] = upper
            upper.children.append(node)
            self.edges[node.keys[node.above]] = upper
            self.edges[node.keys[lo]] = node
            node.parent, node.above = upper, lo
            self.handles[node.handle()] = node
            self.handles[upper.handle()] = upper
            node = upper
        if len(keys) > node.depth:
            leaf = Node(node, node.depth, len(keys), keys, sizes)
            node.children.append(leaf)
            self.edges[keys[node.depth]] = leaf
            self.handles[leaf.handle()] = leaf
            node = leaf
        return node

    def insert_batch(self, batch: list[tuple[list[bytes], list[int], int, int, str]]) -> None:
        """Sequences (keys, sizes, smallest member, members, digest of members): all located first, then inserted by exit node."""
        by: dict[int, list] = {}
        for row in batch:
            node = self.exit(row[0], self.root)
            by.setdefault(id(node), [node]).append(row)
        for node, *rows in by.values():
            start = node.parent or node
            for i, (keys, sizes, low, n, ends) in enumerate(rows):
                own = self.insert(keys, sizes, node if i == 0 else self.exit(keys, start))
                own.ends, own.low, own.n = ends, low, n

    def rows(self, trie: int, first: list[bytes], last: list[bytes]) -> list[tuple]:
        """Expanded nodes; those on the paths of the first and last sequence stay open."""
        on_first, on_last = {ROOT, *first}, {ROOT, *last}
        order, todo = [], [self.root]
        while todo:
            node = todo.pop()
            order.append(node)
            todo += node.children
        out: list[tuple] = []
        totals: dict[int, tuple] = {}               # of a node's edge: closed or not, members, smallest, leaves, saved
        for node in reversed(order):
            n, low = node.n, node.low
            children = leaves = saved = 0
            for c in node.children:
                closed, cn, clow, cleaves, csaved = totals.pop(id(c))
                n, low = n + cn, clow if low is None else min(low, clow)
                if closed:
                    children, leaves, saved = children + 1, leaves + cleaves, saved + csaved
            closed = True
            for d in range(node.depth, max(node.above, -1), -1):
                key = node.keys[d - 1] if d else ROOT
                parent = None if d == 0 else node.keys[d - 2] if d > 1 else ROOT
                size = node.sizes[d - 1] if d else 0
                f, z = key in on_first, key in on_last
                if d < node.depth:
                    children = 1 if closed else 0
                    if not closed:
                        leaves = saved = 0
                closed = not (f or z)
                if closed:
                    leaves, saved = leaves or 1, saved + (n - 1) * size
                open_parent = closed and (parent in on_first or parent in on_last)
                out.append([trie, key, parent, d, low, n, children, leaves, saved, size, node.ends if d == node.depth else None, f, z, not closed,
                            None, open_parent])
            totals[id(node)] = (closed, n, low, leaves, saved)
        lows = {r[1]: r[4] for r in out}
        for r in out:
            if not r.pop() and not r[13]:
                r[14] = lows[r[2]]
        return out


def table(rows: list) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(ARROW), ARROW)], schema=ARROW)


def merge(t: pa.Table, shift: int, final: bool) -> pa.Table:
    """Open nodes of neighbouring tries as those of one; nodes inside it are closed."""
    rows = t.to_pylist()
    least, most = min(r["trie"] for r in rows), max(r["trie"] for r in rows)
    nodes: dict[bytes, dict] = {}
    for r in rows:
        f, z = r["first"] and r["trie"] == least, r["last"] and r["trie"] == most
        x = nodes.get(r["key"])
        if x is None:
            nodes[r["key"]] = r | {"first": f, "last": z}
            continue
        for c in ("n", "children", "leaves", "saved"):
            x[c] += r[c]
        x["low"], x["ends"], x["first"], x["last"] = min(x["low"], r["low"]), x["ends"] or r["ends"], x["first"] or f, x["last"] or z
    for x in sorted(nodes.values(), key=lambda x: -x["depth"]):
        x["trie"] >>= shift
        x["open"] = not final and (x["first"] or x["last"])
        if not x["open"]:
            x["leaves"] = x["leaves"] or 1
            x["saved"] += (x["n"] - 1) * x["size"]
        up = nodes.get(x["parent"]) if x["depth"] else None
        if up is not None and not x["open"]:
            up["children"], up["leaves"], up["saved"] = up["children"] + 1, up["leaves"] + x["leaves"], up["saved"] + x["saved"]
    for x in nodes.values():
        up = nodes.get(x["parent"]) if x["depth"] else None
        x["parent_low"] = up["low"] if up is not None and not x["open"] and not (not final and (up["first"] or up["last"])) else None
    return table([[x[c] for c in NAMES] for x in nodes.values()])


def rebuilt(turns: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """(conv_id, turns): the first h turns of conversation c - c % block, then c's own after its first h; h is the id's crc32 modulo ``most``."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(
        F.col("turn").alias("turn"), F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("key"),
        F.char_length(text).alias("size")).alias("t"))
    # a null turn sorts before the others
    own = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("own"))
    own = stored(own.select("conv_id", F.transform("own", lambda t: F.struct(t["key"].alias("key"), t["size"].alias("size"))).alias("own")), "trie-own")
    heads = own.where(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("base"), F.slice("own", 1, most - 1).alias("head"))
    h = (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % most).cast("int")
    all_ = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % block).join(heads, "base", "left").withColumn("h", h)
    start = F.coalesce(F.expr("slice(head, 1, h)"), F.expr("slice(own, 1, 0)"))
    return all_.select("conv_id", F.concat(start, F.expr("slice(own, h + 1, size(own))")).alias("turns"))


def member_digests(members: DataFrame, bits: int = 12) -> DataFrame:
    """(node, ends): digest of the ascending ids that end in a node, comma-joined, of ``members`` (node, conv_id)."""
    pieces = members.groupBy("node", F.shiftright("conv_id", bits).alias("piece")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done = []
            for k, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if k == node:
                    digest.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = k, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_pydict({"node": pa.array([x for x, _ in done], pa.string()), "ends": pa.array([x for _, x in done], pa.string())})
        if node is not None:
            yield pa.RecordBatch.from_pydict({"node": [node], "ends": [digest.hexdigest()]})

    return pieces.repartition("node").sortWithinPartitions("node", "piece").mapInArrow(run, "node string, ends string")


def trie_nodes(sequences: DataFrame, run: int = 20_000, batch: int = 1_000, width_bits: int = 5) -> DataFrame:
    """Every prefix of ``sequences`` (conv_id, turns: array of (key, size)) as a node, the empty one included.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)
    """
    keys = F.transform("turns", lambda t: t["key"])
    rows = sequences.select("conv_id", keys.alias("keys"), F.transform("turns", lambda t: t["size"]).alias("sizes"))
    rows = stored(rows.withColumn("node", F.concat(F.md5(F.array_join("keys", "")), F.size("keys").cast("string"))), "trie-sequences")
    distinct = rows.groupBy("node").agg(F.min("conv_id").alias("low"), F.count("*").alias("n"), F.first("keys").alias("keys"), F.first("sizes").alias("sizes"))
    distinct = stored(distinct.join(member_digests(rows.select("node", "conv_id")), "node").drop("node"), "trie-distinct")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        k, trie, count, first, last = 0, ZFastTrie(), 0, None, None
        part = TaskContext.get().partitionId() << RUNS

        def done() -> Iterator[pa.RecordBatch]:
            yield from table(trie.rows(part + k, first, last)).to_batches(max_chunksize=10_000)

        for b in batches:
            for s in range(0, b.num_rows, batch):
                piece = b.slice(s, batch).to_pydict()
                rows = [(chained(x), y, *z) for x, y, *z in zip(*(piece[c] for c in ("keys", "sizes", "low", "n", "ends")))]
                trie.insert_batch(rows)
                first, last, count = first if count else rows[0][0], rows[-1][0], count + len(rows)
                if count >= run:
                    yield from done()
                    k, trie, count = k + 1, ZFastTrie(), 0
        if count:
            yield from done()

    local = stored(distinct.repartitionByRange("keys").sortWithinPartitions("keys").mapInArrow(build, NODE), "trie-nodes")
    # numbers of neighbouring tries without the gaps that their runs leave
    in_part = F.col("trie").bitwiseAND((1 << RUNS) - 1)
    top, runs = local.agg(F.max("trie"), F.max(in_part)).first()
    bits = (runs or 0).bit_length()
    number = F.shiftleft(F.shiftright("trie", RUNS), bits) + in_part
    closed, open_ = [local.where("NOT open")], local.where("open").withColumn("trie", number)
    top = None if top is None else (top >> RUNS << bits) + runs

    def merger(final: bool) -> Callable[[pa.Table], pa.Table]:
        return lambda t: merge(t.drop(["group"]), width_bits, final)

    while top is not None:
        final = top >> width_bits == 0
        here = stored(open_.withColumn("group", F.shiftright("trie", width_bits)).groupBy("group").applyInArrow(merger(final), NODE), "trie-merged")
        closed.append(here.where("NOT open"))
        open_, top = here.where("open"), None if final else top >> width_bits
    nodes = closed[0]
    for x in closed[1:]:
        nodes = nodes.unionByName(x)
    # a child that closed before its parent gets the parent's smallest member from the merged nodes
    late = closed[1:] and closed[1]
    for x in closed[2:]:
        late = late.unionByName(x)
    waiting = F.col("parent_low").isNull() & (F.col("depth") > 0)
    out = nodes.where(~waiting)
    if late:
        parents = late.select(F.col("key").alias("parent"), F.col("low").alias("_low"))
        out = out.unionByName(nodes.where(waiting).join(parents, "parent").withColumn("parent_low", F.col("_low")).drop("_low"))
    return out.select(F.col("low").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.col("parent_low").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                      F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                      F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
