"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

Texts become sets of hashed word shingles; texts of equal sets are one class.  A forest of
tries holds each class once per tree under a label of minimum hashes.  A pair meets in
a tree if it shares a label prefix; prefixes are shortened from the full label until the chance
that a pair at the threshold meets in some tree reaches the target recall.  Tries are
tables sorted by (tree, prefix); a node with many classes is cut into pairs of bounded
chunks.  A pair is verified in the first tree where it meets, from the full shingle sets:
first a pass over labels alone keeps the classes that have such a pair, then only
their sets are sent.  A chunk pair gives link counts and a spanning forest, never its links.

Words are as in :data:`WORD` after lower-casing A-Z; a text of fewer words than a shingle is one
shingle.  Defined results: null, empty and word-less texts link with nothing; repeated rows and
equal texts link with each other; a row of null id stands under a negative hash of its text; rows that
share an id but not the text are nodes of their own, and of a component the row with the smallest id, then
hash of its text, is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sevlens.llm.common import connected_components, min_roots, placed, rebatched, small_batches, stored, those_held

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(x: int, n: int) -> np.ndarray:
    out = np.full(n, x, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles."""

    def __init__(self, words: int):
        self.words, self.up, self.down = words, _powers(_BASE, 1), _powers(_INVERSE, 1)

    def __call__(self, text: str) -> np.ndarray:
        b = _LOWER[np.frombuffer(text.encode(), np.uint8)]
        if len(b) >= len(self.up):
            self.up, self.down = _powers(_BASE, 2 * len(b) + 1), _powers(_INVERSE, 2 * len(b) + 1)
        edge = np.diff(np.concatenate([[0], _WORD[b].astype(np.int8), [0]]))
        s, e = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
        if not len(s):
            return np.zeros(0, np.uint64)
        total = np.concatenate([[np.uint64(0)], np.cumsum((b + np.uint64(1)) * self.down[:len(b)])])
        w = mixed((total[e] - total[s]) * self.up[e])          # of the word's bytes, wherever it stands
        n = min(self.words, len(w))
        h = np.full(len(w) - n + 1, n, np.uint64)
        for i in range(n):
            h = mixed(h * np.uint64(_BASE) + w[i:len(w) - n + 1 + i])
        return np.unique(h)


def parted(h: np.ndarray, part: int) -> np.ndarray:
    """The shingles of a part: those of different parts are never equal but for a collision; part 0 has them as they are."""
    return np.sort(mixed(h + np.uint64(part % (1 << 64)) * np.uint64(_BASE))) if part else h


def prefix_length(threshold: float, trees: int, depth: int, recall: float) -> int:
    """Longest label prefix, shortened from ``depth``, at which a pair at the threshold meets with ``recall``."""
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < recall:
        depth -= 1
    return depth


def labels(h: np.ndarray, a: np.ndarray, b: np.ndarray, trees: int) -> np.ndarray:
    """One 64-bit key for each tree: its prefix of minimum hashes."""
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(h), 512):
        least = np.minimum(least, (np.multiply.outer(h[i:i + 512], a) ^ b).min(axis=0))
    least = mixed(least).reshape(trees, -1)
    key = np.zeros(trees, np.uint64)
    for column in least.T:
        key = mixed(key * np.uint64(_BASE) + column)
    return key.view(np.int64)


def linked_pairs(a: list, b: list, ka: np.ndarray, kb: np.ndarray, tree: int, threshold: float, same: bool) -> Iterator[tuple[int, int]]:
    """Pairs of the two chunks that first meet in ``tree`` and reach the threshold."""
    need = first_meet(ka, kb, tree, same, np.array([len(x) for x in a]), np.array([len(x) for x in b]), threshold)
    i, j = np.nonzero(need)
    if len(i) <= 200:
        for p, q in zip(i.tolist(), j.tolist()):
            both = len(a[p]) + len(b[q]) - len(np.unique(np.concatenate([a[p], b[q]])))
            if both >= threshold * (len(a[p]) + len(b[q]) - both):
                yield p, q
        return
    rows = a if same else a + b
    size = np.array([len(x) for x in rows])
    values, column, held = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    owner, shared = np.repeat(np.arange(len(rows)), size), held[column] > 1
    new = np.cumsum(held > 1) - 1
    owner, column = owner[shared], new[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column, n = owner[order], column[order], int((held > 1).sum())
    both = np.zeros((len(rows), len(rows)), np.float32)
    for s in range(0, n, 8192):                  # common shingles, a block of columns at a time
        lo, hi = np.searchsorted(column, [s, s + 8192])
        m = np.zeros((len(rows), 8192), np.float32)
        m[owner[lo:hi], column[lo:hi] - s] = 1
        both += m @ m.T
    shift = 0 if same else len(a)
    common = both[i, j + shift].astype(np.float64)
    ok = common >= threshold * (size[i] + size[j + shift] - common)
    yield from zip(i[ok].tolist(), j[ok].tolist())


def first_meet(ka: np.ndarray, kb: np.ndarray, tree: int, same: bool, na: np.ndarray, nb: np.ndarray, threshold: float) -> np.ndarray:
    """Matrix of the pairs that meet in no earlier tree and whose sizes allow the threshold."""
    least, most = np.minimum.outer(na, nb), np.maximum.outer(na, nb)
    need = least >= threshold * most
    for t in range(tree):
        need &= ka[:, t][:, None] != kb[:, t][None, :]
    return np.triu(need, 1) if same else need


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each chunk pair (``tile``), which arrive together but may be cut by batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        tile = batch.column("tile").to_numpy()
        at = [0, *(np.nonzero(np.diff(tile))[0] + 1).tolist(), len(tile)] if len(tile) else [0]
        for s, e in zip(at[:-1], at[1:]):
            if held and held[0].column("tile")[0].as_py() != int(tile[s]):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(s, e - s))
    if held:
        yield pa.Table.from_batches(held)


def sides(t: pa.Table, trees: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool, int]:
    side = t["side"].to_numpy()
    keys = np.array([np.frombuffer(k, "<i8") for k in t["keys"].to_pylist()]).reshape(-1, trees)
    same = not (side == 1).any()
    a = np.nonzero(side == 0)[0]
    return keys, a, a if same else np.nonzero(side == 1)[0], same, t["tree"][0].as_py()


def join(docs: DataFrame, threshold: float = 0.8, words: int = 5, trees: int = 20, depth: int = 8, recall: float = 0.999,
         chunk: int = 256, within: str | None = None) -> DataFrame:
    """(doc_id, class_id, n_links, component_id, kept, id, text_hash) for every row of ``docs`` (doc_id, text).

    ``id`` is the row's own or, for a null one, a hash of the text; a row is known by it and ``text_hash``.
    Only rows of one value of ``within`` (a whole number, not null; then also returned, and part of ``text_hash``) link.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("doc_id").cast("long"), -1 - F.shiftrightunsigned(F.xxhash64(text), 1)).alias("id"), text.alias("text"), (F.col(within) if within else F.lit(0)).cast("long").alias("part"))
    docs = docs.withColumn("text_hash", F.xxhash64("text", "part") if within else F.xxhash64("text"))
    length = prefix_length(threshold, trees, depth, recall)
    seeds = np.random.Generator(np.random.PCG64(8)).integers(0, 1 << 63, (2, trees * length), dtype=np.uint64)
    a, b = seeds[0] * np.uint64(2) + np.uint64(1), seeds[1] * np.uint64(2)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(words)
        for batch in rebatched(batches):
            n, sets, keys = [], [], []
            for t, part in zip(batch.column("text").to_pylist(), batch.column("part").to_pylist()):
                h = parted(shingles(t), part)
                n.append(len(h))
                sets.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest())
                keys.append(labels(h, a, b, trees).astype("<i8").tobytes() if len(h) else b"")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("id"), batch.column("text_hash"), batch.column("part"), pa.array(n, pa.int64()),
                                              pa.array(sets, pa.binary()), pa.array(keys, pa.binary())],
                                             names=["doc_id", "id", "text_hash", "part", "n", "shingles", "keys"])

    signed = stored(docs.mapInArrow(sign, "doc_id long, id long, text_hash long, part long, n long, shingles binary, keys binary"), "signatures")
    classes = stored(signed.where("n > 0").groupBy("shingles").agg(
        F.min(F.struct("id", "text_hash")).alias("first"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("keys").alias("keys"))
        .select("shingles", F.col("first.id").alias("own"), F.col("first.text_hash").alias("own_hash"), "copies", "n", "keys"), "classes")
    # a class's number, in the order of its first rows: rows of one id may belong to several classes
    order = placed(classes.select(F.lit("").alias("tree"), "own", "own_hash", "shingles"), ["own", "own_hash", "shingles"], "jaccard-order")
    classes = stored(classes.join(order.select("shingles", F.col("pos").alias("id")), "shingles"), "numbered-classes")

    # the tries: a node is a (tree, prefix); only nodes of two classes or more go on
    part = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.xxhash64(t, F.substring("keys", t * 8 + 1, F.lit(8))))
    held = classes.select("id", F.posexplode(part).alias("tree", "node"))
    crowded = held.groupBy("node").agg(F.count("*").alias("m")).where("m > 1")
    cut = F.ceil(F.col("m") / chunk)
    own = F.pmod(F.xxhash64("id", "tree"), "cuts").cast("int")
    met = (held.join(crowded, "node").withColumn("cuts", cut).withColumn("own", own)
           .select("id", "tree", "node", "own", F.explode(F.sequence(F.lit(0), F.col("cuts").cast("int") - 1)).alias("other")))
    tile = F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")).alias("tile")
    side = (F.col("own") > F.col("other")).cast("int").alias("side")
    met = met.select("id", "tree", tile, side)

    def first_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in chunks(batches):
            keys, x, y, same, tree = sides(t, trees)
            n = t["n"].to_numpy()
            need = first_meet(keys[x], keys[y], tree, same, n[x], n[y], threshold)
            some = np.zeros(len(n), bool)
            some[x] |= need.any(axis=1)
            some[y] |= need.any(axis=0)
            if some.any():
                yield t.select(["id", "tree", "tile", "side"]).filter(pa.array(some)).combine_chunks().to_batches()[0]

    slim = met.join(classes.select("id", "n", "keys"), "id")
    wanted = stored(slim.repartition("tile").sortWithinPartitions("tile").mapInArrow(
        first_pairs, "id long, tree int, tile long, side int"), "first-pairs")

    # shingle sets of the classes in question, from the class's first document
    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(words)
        for batch in rebatched(batches):
            sets = [parted(shingles(t), part).tobytes() for t, part in zip(batch.column("text").to_pylist(), batch.column("part").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("own"), batch.column("own_hash"), pa.array(sets, pa.binary())], names=["own", "own_hash", "h"])

    some = classes.join(wanted.select("id").distinct(), "id").select("own", "own_hash", "id", "copies", "keys")
    some = stored(some, "first-pair-classes")
    rows = those_held(docs.select(F.col("id").alias("own"), F.col("text_hash").alias("own_hash"), "text", "part"), some, "own", "own_hash")
    sets = rows.mapInArrow(shingle, "own long, own_hash long, h binary").dropDuplicates(["own", "own_hash"])
    full = stored(sets.join(some, ["own", "own_hash"]).drop("own", "own_hash"), "shingle-sets")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in chunks(batches):
            keys, x, y, same, tree = sides(t, trees)
            h = [np.frombuffer(v, np.uint64) for v in t["h"].to_pylist()]
            ids, copies = t["id"].to_numpy(), t["copies"].to_numpy()
            links = np.zeros(len(ids), np.int64)
            found = list(linked_pairs([h[i] for i in x], [h[i] for i in y], keys[x], keys[y], tree, threshold, same))
            if not found:
                continue
            p, q = x[[i for i, _ in found]], y[[j for _, j in found]]
            links = np.bincount(p, copies[q], len(ids)) + np.bincount(q, copies[p], len(ids))
            order = np.argsort(ids)
            rank = np.argsort(order)
            root = min_roots(rank[p], rank[q], len(ids))
            some = np.nonzero(links)[0]
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some].astype(np.int64)), pa.array(ids[order[root[rank[some]]]])],
                                             names=["id", "links", "peer"])

    linked = stored(wanted.join(full, "id").repartition("tile").sortWithinPartitions("tile").mapInArrow(
        verify, "id long, links long, peer long"), "jaccard-links")
    links = linked.groupBy("id").agg(F.sum("links").alias("links"))
    parts = connected_components(linked.select(F.col("id").alias("u"), F.col("peer").alias("v")), "jaccard-components")
    first = classes.select(F.col("id").alias("component"), F.col("own").alias("first_id"), F.col("own_hash").alias("first_hash"))
    result = (classes.select("shingles", "id", "own", "copies").join(links, "id", "left").join(parts.withColumnRenamed("node", "id"), "id", "left")
              .withColumn("component", F.coalesce("component", "id")).join(first, "component")
              .select(F.col("shingles").alias("_s"), F.col("own").alias("class_id"), "copies", "links", "first_id", "first_hash"))
    out = signed.join(result, F.when(F.col("n") > 0, F.col("shingles")) == F.col("_s"), "left")
    kept = (F.col("id") == F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))
    return out.select("doc_id", F.coalesce("class_id", "id").alias("class_id"),
                      F.coalesce(F.coalesce("links", F.lit(0)) + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("first_id", "id").alias("component_id"), F.coalesce(kept, F.lit(True)).alias("kept"), "id", "text_hash", *([F.col("part").alias(within)] if within else []))
